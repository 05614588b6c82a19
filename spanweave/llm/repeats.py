"""Exact removal of repeated substrings with suffix arrays, at the scale of a corpus.

A string of LENGTH bytes that also starts anywhere else is removed wherever it stands.  A suffix
array of the whole corpus would order hundreds of suffixes for each string that repeats, so the
text is anchored first:

1. Each string of LENGTH bytes has an *anchor*, the leftmost of its GRAM-byte substrings with the
   least hash.  Equal strings have equal anchors at equal offsets, and neighbouring strings mostly
   share an anchor, so an anchor stands for a run of strings, whose bytes are its *context*.  One
   pass over the texts writes a row for each anchor met: hashes, document and place.
2. Anchors and contexts are counted by hash.  An anchor met once cannot repeat.  A context met more
   than once repeats whole.  The other contexts of anchors that repeat are *open*: some of their
   strings may stand in other contexts of the anchor.
3. The bytes of open contexts, and of one occurrence of each whole one beside them, go to the task of
   the anchor.  There their right sides, and their left sides read backwards, are coded in blocks
   and ordered with suffix arrays built by linear grouping (``suffixes.suffix_array``).  With the
   common prefixes of neighbours in either order, strings of two contexts at the same offset are
   equal exactly if both sides fall in the same classes at their lengths there.
4. The removed ranges go back to their texts.

Texts are shuffled once, compressed one by one; both the requests for bytes and the removed ranges
meet them there.  Contexts that repeat whole are told by two 64-bit hashes, that of the anchor and
XXH3 of the context's bytes and the anchor's place in it; that an anchor's hash may stand for two
strings does no harm, as the bytes are compared.  Anchors with more than CROWD contexts would make
one task's group too large; their strings are counted one by one by their BLAKE2 digests, in Spark, instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanweave.shipping import ship

from .common import cut, forget, map_batches, n_partitions, release, table, text_of
from .suffixes import suffix_array

LENGTH, GRAM = 200, 32
SPAN = LENGTH - GRAM + 1
#: Bytes of a text anchored at a time; strings across a cut are kept.
BLOCK = 4 << 20
#: Contexts of an anchor beyond which its strings are counted by hash in Spark.
CROWD = 100_000
#: Bits of the filter that tells most anchors met once from the others before they are joined; its
#: size is the same for every corpus, and what it lets through by chance the join drops.
FILTER_BITS = 27
#: Distinct contexts solved at a time.
CHUNK = 8_192
RIGHT_BLOCK, LEFT_BLOCK = 50, 56

_PRIME = np.uint64(0x100000001B3)
_UNPRIME = np.uint64(pow(0x100000001B3, -1, 1 << 64))


class Anchors:
    """Finds the anchors of a text; holds powers for one block."""

    def __init__(self):
        n = 4096
        self.grow(n)

    def grow(self, n: int) -> None:
        self.power = np.cumprod(np.r_[np.uint64(1), np.full(n, _PRIME)], dtype=np.uint64)
        self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(n, _UNPRIME)], dtype=np.uint64)

    def __call__(self, raw: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each block: its place, and each anchor's hash, place, and first and last string."""
        for at in range(0, max(1, len(raw) - LENGTH + 1), BLOCK):
            part = np.frombuffer(raw, np.uint8)[at : at + BLOCK + LENGTH - 1]
            if len(part) >= LENGTH:
                yield (at, *self.block(part))

    def sums(self, part: np.ndarray) -> np.ndarray:
        if len(part) >= len(self.power):
            self.grow(2 * len(part))
        return np.cumsum(np.r_[np.uint64(0), (part + np.uint64(1)) * self.power[: len(part)]], dtype=np.uint64)

    def block(self, part: np.ndarray):
        sums = self.sums(part)
        h = _mix((sums[GRAM:] - sums[:-GRAM]) * self.inverse[: len(part) - GRAM + 1])
        # The least hash and, of equal ones, the leftmost: hash bits above, place below.
        place = np.uint64((1 << 23) - 1)
        key = (h & ~place) | np.arange(len(h), dtype=np.uint64)
        chosen = (_window_min(key, SPAN) & place).astype(np.int64)
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        last = np.r_[first[1:], len(chosen)] - 1
        where = chosen[first]
        return h[where].view(np.int64), where, first, last


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _window_min(a: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours."""
    n = len(a)
    padded = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[:n] = a
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__sw_d, __sw_k``, its doc_id (null as 0) and a hash of its text.

    Only rows of one id and one text share the key, so copies of a text are spread by their ids.
    """
    return docs.withColumns({"__sw_d": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "__sw_k": F.xxhash64(text_of())})


#: A context's place in its text in one number: first byte, bytes before the anchor, bytes.
def _spot(lo: np.ndarray, lead: np.ndarray, size: np.ndarray) -> np.ndarray:
    return lo << 20 | lead << 10 | size


def _read_spot(spot: int) -> tuple[int, int, int]:
    return spot >> 20, spot >> 10 & 1023, spot & 1023


def _joined(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _occurrences(docs: DataFrame) -> DataFrame:
    """``anchor, context, d, k, spot``: a row for each anchor met, from one pass over the texts."""

    def make():
        anchors, digest = Anchors(), xxhash.xxh3_64_intdigest

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found, owner = [], []
            for i, text in enumerate(batch.column(2).to_pylist()):
                raw = text.encode()
                for at, h, where, first, last in anchors(raw):
                    lo, lead, size = at + first, where - first, last - first + LENGTH
                    context = [digest(raw[a:b], s) for a, b, s in zip(lo.tolist(), (lo + size).tolist(), lead.tolist(), strict=True)]
                    found.append((h, np.array(context, np.uint64).view(np.int64), _spot(lo, lead, size)))
                    owner.append(np.full(len(h), i))
            of = pa.array(_joined(owner))
            h, context, spot = (pa.array(_joined([x[i] for x in found])) for i in range(3))
            return pa.RecordBatch.from_arrays([h, context, batch.column(0).take(of), batch.column(1).take(of), spot], ["anchor", "context", "d", "k", "spot"])

        return step

    rows = _keyed(docs).select("__sw_d", "__sw_k", text_of().alias("text"))
    return map_batches(rows, make, "anchor long, context long, d long, k long, spot long")


def _of_repeating(met: DataFrame, bits: int) -> DataFrame:
    """Rows of ``met`` whose anchor is met again, and some others.

    The anchors met again go into a filter of ``1 << bits`` bits by their leading bits, which is
    broadcast.
    """
    again = met.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    at = F.shiftrightunsigned("anchor", 64 - bits)
    one = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(anchor, {64 - bits}) & 63 as int))")
    found = again.groupBy(F.shiftright(at, 6).alias("w")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[found["w"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    shared = met.sparkSession.sparkContext.broadcast(words)

    def make():
        filled = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            bit = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            return batch.filter(pa.array((filled[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)))

        return step

    return map_batches(met, make, met.schema, rows=65_536)


def _known(met: DataFrame, crowd: int) -> DataFrame:
    """``anchor, context, n, one, open, crowded``: contexts that are whole or whose anchor has open ones.

    ``n`` is how often the context is met and ``one`` names one of these.
    """
    each = cut(met.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(F.xxhash64("d", "k", "spot")).alias("one")))
    # Tables of their own, so that adaptive execution may split the join at an anchor of very many.
    per = cut(each.groupBy("anchor").agg(F.count("*").alias("contexts"), F.count_if(F.col("n") == 1).alias("alone")).where("contexts > 1 and alone > 0"))
    both = each.join(per, "anchor", "left").where("n > 1 or contexts is not null")
    known = cut(both.select("anchor", "context", "n", "one", F.col("contexts").isNotNull().alias("open"), F.coalesce(F.col("contexts") > crowd, F.lit(False)).alias("crowded")))
    forget(each, per)
    return known


def _marked(met: DataFrame, known: DataFrame) -> DataFrame:
    """``__sw_d, __sw_k, __sw_whole, __sw_asked``: of each document its contexts that repeat whole
    and those whose bytes are needed; at most one of each for each of its anchors.
    """
    found = met.join(known, ["anchor", "context"])
    whole = F.when(F.col("n") > 1, F.col("spot"))
    asked = F.when(F.col("open") & ((F.col("n") == 1) | (F.col("one") == F.xxhash64("d", "k", "spot"))), F.struct("anchor", "spot", "crowded"))
    marks = found.groupBy("d", "k").agg(F.collect_list(whole).alias("__sw_whole"), F.collect_list(asked).alias("__sw_asked"))
    return marks.withColumnsRenamed({"d": "__sw_d", "k": "__sw_k"})


def _packed(docs: DataFrame) -> DataFrame:
    """``docs`` with its key and, for ``text``, the text compressed as ``__sw_z`` (null: null)."""
    keyed = _keyed(docs)
    kept = [c for c in keyed.columns if c != "text"]

    def make():
        pack = zstandard.ZstdCompressor(level=1)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            z = [None if t is None else pack.compress(t.encode()) for t in batch.column("text").to_pylist()]
            return pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(z, pa.binary())], [*kept, "__sw_z"])

        return step

    return map_batches(keyed, make, T.StructType([*(keyed.schema[c] for c in kept), T.StructField("__sw_z", T.BinaryType())]))


CONTEXT = "anchor long, context binary, lead int, crowded boolean, d long, k long, at long"


def _contexts(marked: DataFrame) -> DataFrame:
    """``anchor, context, lead, crowded, d, k, at``: the bytes that documents are asked for."""

    def make():
        unpack = zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for d, k, z, asked in zip(*(batch.column(c).to_pylist() for c in ("__sw_d", "__sw_k", "__sw_z", "__sw_asked")), strict=True):
                if asked and z is not None:
                    raw = unpack.decompress(z)
                    for one in asked:
                        lo, lead, size = _read_spot(one["spot"])
                        rows.append((one["anchor"], raw[lo : lo + size], lead, one["crowded"], d, k, lo + lead))
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            types = [pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in CONTEXT.split(", ")])

        return step

    return map_batches(marked, make, CONTEXT, rows=256)


def classes(strings: list[bytes], groups: np.ndarray, block: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings (group by group) and, for each after the first, its prefix shared with the one before.

    Strings are at most ``width`` bytes without byte 255.  They are coded as a group symbol and
    symbols of ``block`` bytes, and ordered by the suffix array of all of them in a row.
    """
    n, per = len(strings), -(-width // block)
    shape = np.zeros((n, per * block), np.uint8)
    for i, s in enumerate(strings):
        shape[i, : len(s)] = np.frombuffer(s, np.uint8)
        shape[i, : len(s)] += 1
    used = np.array([-(-len(s) // block) for s in strings])
    mask = np.arange(per) < used[:, None]
    blocks = np.ascontiguousarray(shape.reshape(n * per, block)).view(f"S{block}").ravel()[mask.ravel()]
    coded = np.unique(blocks, return_inverse=True)[1].ravel() + int(groups.max()) + 2
    length = used + 2  # the group, the blocks and a separator
    start = np.r_[0, np.cumsum(length)[:-1]]
    symbols = np.zeros(int(length.sum()), np.int64)
    symbols[start] = groups + 1
    inside = np.ones(len(symbols), bool)
    inside[start] = inside[start + length - 1] = False
    symbols[inside] = coded
    rank = np.empty(len(symbols), np.int64)
    rank[suffix_array(symbols.tolist())] = np.arange(len(symbols))
    order = np.argsort(rank[start])
    a, b = order[:-1], order[1:]
    differs = shape[a] != shape[b]
    same = np.where(differs.any(1), differs.argmax(1), shape.shape[1])
    sizes = np.array([len(s) for s in strings])
    same = np.minimum(same, np.minimum(sizes[a], sizes[b]))
    same[groups[a] != groups[b]] = -1
    return order, np.r_[-1, same]


def repeated(contexts: list[bytes], leads: np.ndarray, groups: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """For each context and offset, whether its string that begins so far before the anchor repeats.

    Contexts of a group have the same anchor; ``weights`` counts how often each occurs.
    """
    n = len(contexts)
    sizes = np.array([len(c) for c in contexts])
    least = leads - (sizes - LENGTH)  # the last string begins so far before the anchor
    right, r_same = classes([c[k:] for c, k in zip(contexts, leads.tolist(), strict=True)], groups, RIGHT_BLOCK, LENGTH)
    left, l_same = classes([c[:k][::-1] for c, k in zip(contexts, leads.tolist(), strict=True)], groups, LEFT_BLOCK, SPAN - 1)
    found = np.zeros((n, SPAN), bool)
    of_left, of_right = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(SPAN):
        has = np.flatnonzero((leads >= o) & (least <= o))
        if not len(has):
            continue
        of_left[left] = np.cumsum(l_same < o)
        of_right[right] = np.cumsum(r_same < LENGTH - o)
        both = of_left[has] * (n + 1) + of_right[has]
        _, which = np.unique(both, return_inverse=True)
        total = np.bincount(which, weights[has])
        found[has, o] = total[which] > 1
    return found


RANGE = "d long, k long, lo long, hi long"


def _ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed ranges of each occurrence, from rows sorted by anchor and context."""
    release()
    contexts: list[bytes] = []
    anchor_of, lead_of, rows = [], [], []  # rows: of each distinct context, (d, k, at) of its occurrences
    held = 0

    def solve(n: int) -> Iterator[pa.RecordBatch]:
        """Settle the first n distinct contexts."""
        groups = np.unique(np.array(anchor_of[:n]), return_inverse=True)[1].ravel()
        weights = np.array([len(r) for r in rows[:n]])
        leads = np.array(lead_of[:n])
        alone = np.bincount(groups, weights)[groups] < 2  # no other context of the anchor came
        some = np.flatnonzero(~alone)
        if len(some):
            hit = repeated([contexts[i] for i in some], leads[some], groups[some], weights[some])
            # A run of offsets o1..o2 that repeat removes the bytes from at - o2 to at - o1 + LENGTH.
            edge = np.diff(np.pad(hit, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            who, o1 = np.nonzero(edge == 1)
            o2 = np.nonzero(edge == -1)[1] - 1
            out = [(d, k, at - b, at - a + LENGTH) for i, a, b in zip(some[who].tolist(), o1.tolist(), o2.tolist(), strict=True) for d, k, at in rows[i]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["d", "k", "lo", "hi"])
        del contexts[:n], anchor_of[:n], lead_of[:n], rows[:n]

    for batch in batches:
        for anchor, context, lead, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not contexts or anchor != anchor_of[-1] or context != contexts[-1] or lead != lead_of[-1]:
                if held >= CHUNK and anchor != anchor_of[-1]:
                    yield from solve(len(contexts))
                    held = 0
                contexts.append(context)
                anchor_of.append(anchor)
                lead_of.append(lead)
                rows.append([])
                held += 1
            rows[-1].append(tuple(row))
    if contexts:
        yield from solve(len(contexts))


def _crowded(contexts: DataFrame) -> DataFrame:
    """Ranges of anchors met too often for one task: each string by its 128-bit BLAKE2, counted in Spark.

    No two strings are known to have one such digest, nor can any be made to.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            digests, lo, owner = [], [], []
            for i, (raw, lead, at) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("context", "lead", "at")), strict=True)):
                n = max(0, len(raw) - LENGTH + 1)
                digests += [hashlib.blake2b(raw[j : j + LENGTH], digest_size=16).digest() for j in range(n)]
                lo.append(at - lead + np.arange(n))
                owner.append(np.full(n, i))
            of = pa.array(_joined(owner))
            return pa.RecordBatch.from_arrays([batch.column("anchor").take(of), pa.array(digests, pa.binary()), *(batch.column(c).take(of) for c in ("d", "k")), pa.array(_joined(lo))], ["anchor", "string", "d", "k", "lo"])

        return step

    strings = map_batches(contexts, make, "anchor long, string binary, d long, k long, lo long", rows=256)
    often = strings.groupBy("anchor", "string").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "string")
    return strings.join(often, ["anchor", "string"]).select("d", "k", "lo", (F.col("lo") + LENGTH).alias("hi"))


def with_ranges(docs: DataFrame, crowd: int = CROWD, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without ``text`` but with ``__sw_z`` (the text, compressed), ``__sw_whole`` and
    ``__sw_ranges``: its contexts that repeat whole, and the other byte ranges that repeat.

    Ranges may overlap.  The two intermediate tables that the plan returned still reads stay in the
    shared folder; those before are deleted.
    """
    spark = docs.sparkSession
    ship(spark)
    all_met = cut(_occurrences(docs))
    met = cut(_of_repeating(all_met, filter_bits))
    forget(all_met)
    known = _known(met, crowd)
    marked = _packed(docs).join(_marked(met, known), ["__sw_d", "__sw_k"], "left")
    sides = _contexts(marked)
    crowded = not known.where("crowded").isEmpty()
    if crowded:
        sides = cut(sides)
    width = max(n_partitions(spark), 3 * spark.sparkContext.defaultParallelism)
    small = sides.where("not crowded") if crowded else sides
    found = small.select("anchor", "context", "lead", "d", "k", "at").repartition(width, "anchor").sortWithinPartitions("anchor", "context", "lead").mapInArrow(_ranges, RANGE)
    if crowded:
        found = found.union(_crowded(sides.where("crowded")))
    ranges = found.groupBy(F.col("d").alias("__sw_d"), F.col("k").alias("__sw_k")).agg(F.collect_set(F.struct("lo", "hi")).alias("__sw_ranges"))
    return marked.join(ranges, ["__sw_d", "__sw_k"], "left")


def merged(whole: list[int] | None, ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of bytes of whole contexts and of ranges."""
    out: list[tuple[int, int]] = []
    of_whole = [(lo, lo + size) for lo, _, size in map(_read_spot, whole or ())]
    for lo, hi in sorted(of_whole + [(r["lo"], r["hi"]) for r in ranges or ()]):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def kept_bytes(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(raw)]
    return b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def remove_repeats(docs: DataFrame, **limits) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``.

    A byte is removed if a string of LENGTH bytes covers it that also starts anywhere else in any
    text, the same one included, judged on the input.  Texts are UTF-8; matches never cross
    documents.

    Null and empty texts: nothing removed.  Texts shorter than LENGTH: never touched.  Repeated
    rows repeat each other.  Very long texts are anchored block by block.  Empty table: empty
    result.  Other columns are dropped.
    """
    marked = with_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")), **limits)

    def make():
        unpack = zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for doc, z, whole, ranges in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "__sw_z", "__sw_whole", "__sw_ranges")), strict=True):
                raw = unpack.decompress(z)
                spans = merged(whole, ranges)
                rows.append((doc, len(raw), sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept_bytes(raw, spans)).hexdigest()))
            types = [pa.int64()] * 4 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

        return step

    return map_batches(marked, make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def strip_repeats(docs: DataFrame, **limits) -> DataFrame:
    """``docs`` with the repeated bytes taken out of ``text`` and ``n_chars`` counted anew.

    A character that a removed range cuts goes whole.  Null texts stay null; all rows stay, repeated
    ones too, whose texts repeat each other.  Very long texts are anchored block by block.  Empty
    table: empty result.  All other columns stay as they are, whatever their names; ``n_chars`` is
    counted only where there is such a column of longs.
    """
    marked = with_ranges(docs, **limits)
    names = docs.columns

    def make():
        unpack = zstandard.ZstdDecompressor()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, counts = [], []
            for z, whole, ranges in zip(*(batch.column(c).to_pylist() for c in ("__sw_z", "__sw_whole", "__sw_ranges")), strict=True):
                raw = None if z is None else unpack.decompress(z)
                texts.append(None if raw is None else kept_bytes(raw, merged(whole, ranges)).decode("utf-8", "ignore"))
                counts.append(None if raw is None else len(texts[-1]))
            new = {"text": pa.array(texts, pa.string()), "n_chars": pa.array(counts, pa.int64())}
            return pa.RecordBatch.from_arrays([new[c] if c == "text" or c == "n_chars" and pa.types.is_int64(batch.column(c).type) else batch.column(c) for c in names], names)

        return step

    return map_batches(marked, make, docs.schema)


def run(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
