"""Benchmark decontamination: size-partitioned MinHash containment search.

Short test items are looked for inside long documents.  An item is contained where at least 80 in
100 of its distinct shingles (five words) occur in the document.  MinHash signatures of a short
item and a long document hardly ever agree, so documents are not sketched to one size; instead
an item of n shingles is represented by its floor(0.2 n) + 1 smallest shingle hashes.  A document
that contains the item lacks at most floor(0.2 n) of its shingles, so it has at least one of
these: the search misses nothing.

Items are partitioned by the size of their shingle set, in powers of two (and by the width of
their shingles, which is less than five words only for items of fewer words).  A document is
looked up in those partitions alone whose items are small enough to be in it, and in each of them
only with its shingle hashes up to the partition's *ceiling*, the largest signature hash there: the
larger the items, the nearer the ceiling is to a fifth of the range.  What shares a hash is verified,
first by 64-bit shingle hashes, then by exact containment of the shingles' words.

Words are maximal runs of characters other than ASCII marks, white space and controls, of the
lower-cased text.  Items of fewer than five words are looked for as one run of all their words;
items without words are contained nowhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, kept, map_batches, table, text_of

SHINGLE, LEAST = 5, 0.8
#: Bytes of item texts up to which the items are broadcast; beyond it they are joined by hash.
BROADCAST_BYTES = 16 << 20
#: Bytes of a text hashed at a time, or more where a word is longer.
BLOCK = 1 << 20
#: Leading bits of a signature hash by which most other hashes are told from it; a fixed size.
CELL_BITS = 20
WORDS = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
_GAP = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")
_LETTER = np.array([bool(WORDS.match(chr(c))) or c > 127 for c in range(256)])
_PRIME = np.uint64(0x100000001B3)
_UNPRIME = np.uint64(pow(0x100000001B3, -1, 1 << 64))
_TOP = np.uint64((1 << 64) - 1)


class _Powers:
    """Powers of the prime and of its inverse, as many as the longest block so far needs."""

    def __init__(self):
        self.up, self.down = (np.empty(0, np.uint64),) * 2

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(2 * n, 4096)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(n, x)], dtype=np.uint64) for x in (_PRIME, _UNPRIME))
        return self.up, self.down


_POWERS = _Powers()


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word of the text, in order; no word is cut, whatever its length."""
    raw = text.lower().encode("utf-8", "surrogatepass")
    found, at = [], 0
    while at < len(raw):
        end = min(len(raw), at + BLOCK)
        if end < len(raw):
            gaps = np.flatnonzero(~_LETTER[np.frombuffer(raw, np.uint8, end - at, at)])
            gap = None if len(gaps) else _GAP.search(raw, end)
            end = at + int(gaps[-1]) + 1 if len(gaps) else gap.start() if gap else len(raw)
        b = np.frombuffer(raw, np.uint8, end - at, at)
        edge = np.flatnonzero(np.diff(np.r_[False, _LETTER[b], False].view(np.int8)))
        if len(edge):
            start, stop = edge[::2], edge[1::2]
            bounds = edge if edge[-1] < len(b) else edge[:-1]
            up, down = _POWERS.of(len(b))
            sums = np.add.reduceat((b + np.uint64(1)) * up[: len(b)], bounds)[::2] * down[start]
            found.append(_mix(sums + (stop - start).astype(np.uint64)))
        at = end
    return np.concatenate(found) if found else np.empty(0, np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(size):
        h = h * _PRIME + words[i : i + n]
    return _mix(h)


def shingles(words: list[str], size: int) -> set[tuple[str, ...]]:
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def signature(text: str) -> tuple[int, int, np.ndarray, np.ndarray]:
    """An item's shingle width, its partition, its shingle hashes in order, and the least of them:
    one more than it may lack.  The partition is the binary logarithm of the number of hashes.
    """
    words = word_hashes(text)
    size = min(SHINGLE, len(words))
    h = np.unique(shingle_hashes(words, size)) if size else np.empty(0, np.uint64)
    return size, len(h).bit_length() - 1, h, h[: int(len(h) - np.ceil(LEAST * len(h) - 1e-9)) + 1]


class Partitions:
    """What a document needs to be looked up: each partition's ceiling, and cells of signature hashes.

    A cell holds the hashes with the same leading bits and, as bits of a number, the partitions
    that have any there.
    """

    def __init__(self):
        self.ceilings: dict[int, dict[int, int]] = {}  # of each width: of each partition
        self.cells: dict[int, np.ndarray] = {}

    def add(self, size: int, band: int, ceiling: int) -> None:
        self.ceilings.setdefault(size, {})[band] = ceiling
        self.cells.setdefault(size, np.zeros(1 << CELL_BITS, np.uint32))

    def look(self, words: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(width, partition, hashes of the document) where one may be in a signature of the partition."""
        for size, ceilings in self.ceilings.items():
            h = shingle_hashes(words, size)
            # The fewest shingles of a partition's items that a document must have.
            fit = {band: top for band, top in ceilings.items() if np.ceil(LEAST * (1 << band) - 1e-9) <= len(h)}
            if not fit:
                continue
            h = h[h <= np.uint64(max(fit.values()))]
            mask = self.cells[size][(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)] & np.uint32(sum(1 << band for band in fit))
            some = np.flatnonzero(mask)
            if len(some):
                h, mask = h[some], mask[some]
                for band, top in fit.items():
                    own = np.unique(h[(mask >> np.uint32(band) & np.uint32(1)).astype(bool) & (h <= np.uint64(top))])
                    if len(own):
                        yield size, band, own


class Items:
    """The test items, partitioned, with their signatures: the query set of a search."""

    def __init__(self, rows: Iterable[tuple[int, str]]):
        self.rows, self.hashes = [], []
        self.partitions, by_hash = Partitions(), {}
        for item_id, text in rows:
            size, band, h, least = signature(text)
            if size:
                for x in least.tolist():
                    by_hash.setdefault((size, band), {}).setdefault(x, []).append(len(self.rows))
                self.rows.append((item_id, text, size))
                self.hashes.append(h)
        self.by_hash, self.keys = by_hash, {}
        for (size, band), found in by_hash.items():
            keys = self.keys[size, band] = np.array(sorted(found), np.uint64)
            self.partitions.add(size, band, int(keys[-1]))
            np.bitwise_or.at(self.partitions.cells[size], (keys >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.uint32(1 << band))

    def within(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, shingles, shingles shared) of the items that the text contains."""
        words, near = word_hashes(text), set()
        for size, band, h in self.partitions.look(words):
            for key in h[np.isin(h, self.keys[size, band])].tolist():
                near.update(self.by_hash[size, band][key])
        return verified(text, words, [(*self.rows[k], self.hashes[k]) for k in sorted(near)])


def load(name: int, rows) -> Items:
    """The items of a broadcast, made once for each worker process while its tasks use them."""
    return kept(("items", name), lambda: Items(rows.value))


def verified(text: str, words: np.ndarray, items: list[tuple[int, str, int, np.ndarray]]) -> list[tuple[int, int, int]]:
    """Of candidate items (id, text, width, hashes), those whose shingles the text holds.

    Hashes that agree bound the shared shingles from above, so most candidates end there.
    """
    found, of_hash, own, plain = [], {}, {}, None
    for item_id, item, size, hashes in items:
        if size not in of_hash:
            of_hash[size] = np.unique(shingle_hashes(words, size))
        if np.isin(hashes, of_hash[size], assume_unique=True).sum() < LEAST * len(hashes) - 1e-9:
            continue
        if size not in own:
            plain = plain or WORDS.findall(text.lower())
            own[size] = shingles(plain, size)
        wanted = shingles(WORDS.findall(item.lower()), size)
        shared = len(wanted & own[size])
        if shared >= LEAST * len(wanted) - 1e-9:
            found.append((item_id, len(wanted), shared))
    return found


PAIR = "doc_id long, item_id long, n_shingles long, n_shared long, containment double"


def contained_items(docs: DataFrame, items: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_shared, containment``: a row for each pair of a document and an item in it.

    Items whose texts take at most ``broadcast_bytes`` (measured first) are broadcast and every
    document is searched in one pass without a shuffle.  Beyond that, only the partitions' ceilings
    and cells are broadcast (of a fixed size), what documents have there is joined with the items'
    signatures by partition and hash, each distinct text once, and the pairs are verified where lots of
    each document's candidates meet its text.

    Null texts: as empty, in nothing and with nothing.  Very long texts and words are taken whole.
    Repeated documents or items: pairs for each row.  Empty tables: empty result.  Other columns
    are dropped.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0)).alias("n")).first()["n"]
    if size > broadcast_bytes:
        return _joined(docs, items)
    rows = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in items.collect()])
    name = hash((docs.sparkSession.sparkContext.applicationId, rows._jbroadcast.id()))

    def make():
        search = load(name, rows)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [(d, i, n, k, k / n) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for i, n, k in search.within(t)]
            return _pairs(out)

        return step

    return map_batches(docs, make, PAIR, keeps=True)


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    types = [pa.int64()] * 4 + [pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [c.split()[0] for c in PAIR.split(", ")])


SIGNED = "row long, size int, band int, hash long"


def _signed(rows: list[tuple[int, int, int, np.ndarray]]) -> pa.RecordBatch:
    counts = np.array([len(h) for *_, h in rows], np.int64)
    row, size, band = (np.repeat(np.array([x[k] for x in rows], np.int64), counts) for k in range(3))
    h = np.concatenate([h for *_, h in rows]).view(np.int64) if rows else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(row), pa.array(size, pa.int32()), pa.array(band, pa.int32()), pa.array(h)], ["row", "size", "band", "hash"])


def partitions(signatures: DataFrame) -> Partitions:
    """Ceilings and cells of ``signatures`` (size, band, hash): a row for each partition, and for each
    width at most one for each cell, reach the driver.
    """
    out, flip = Partitions(), -(1 << 63)
    tops = signatures.groupBy("size", "band").agg(F.max(F.col("hash").bitwiseXOR(F.lit(flip))).alias("top")).collect()
    for r in tops:
        out.add(r["size"], r["band"], (r["top"] ^ flip) & int(_TOP))
    cell = F.shiftrightunsigned("hash", 64 - CELL_BITS).cast("int")
    found = signatures.groupBy("size", cell.alias("cell")).agg(F.bit_or(F.expr("shiftleft(1, band)")).alias("bands")).toArrow()
    sizes, at, bands = (found[c].to_numpy() for c in ("size", "cell", "bands"))
    for size, cells in out.cells.items():
        cells[at[sizes == size]] = bands[sizes == size].view(np.uint32)
    return out


#: Candidate items of a document that are verified in one row.
TOGETHER = 256


def _joined(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The search with more items than may be broadcast.

    Texts are searched once however many documents or items have them, and pairs of texts become those of
    rows at the end.  A document's candidates are verified in lots of about TOGETHER, so a signature that very
    many items share makes more rows and no longer ones.
    """
    named = lambda df, key: df.withColumn(key, F.xxhash64("text"))
    left, right = named(docs, "doc_text"), named(items, "item_text")
    once = lambda df, key: cut(df.groupBy(key).agg(F.first("text").alias("text")))
    doc_texts, item_texts = once(left, "doc_text"), once(right, "item_text")

    def sign():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [(row, *signature(text)) for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            return _signed([(row, size, band, least) for row, size, band, _, least in found if size])

        return step

    signatures = cut(map_batches(item_texts, sign, SIGNED))
    shared = docs.sparkSession.sparkContext.broadcast(partitions(signatures))

    def look():
        known = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            return _signed([(row, *found) for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for found in known.look(word_hashes(text))])

        return step

    marks = map_batches(doc_texts, look, SIGNED)
    pairs = cut(marks.withColumnRenamed("row", "doc_text").join(signatures.withColumnRenamed("row", "item_text"), ["size", "band", "hash"]).select("doc_text", "item_text").distinct())
    lots = pairs.groupBy("doc_text").agg(F.ceil(F.count("*") / TOGETHER).alias("lots"))
    lot = F.pmod(F.col("item_text"), F.col("lots"))
    asked = pairs.join(lots, "doc_text").join(item_texts.withColumnRenamed("text", "item"), "item_text").groupBy("doc_text", lot.alias("lot"))
    near = asked.agg(F.collect_list(F.struct("item_text", "item")).alias("items"))
    both = doc_texts.join(near, "doc_text").select("doc_text", "text", "items")

    def check():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for d, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                signed = ((x["item_text"], x["item"], *signature(x["item"])) for x in found)
                out += [(d, i, n, k, k / n) for i, n, k in verified(text, word_hashes(text), [(i, item, size, h) for i, item, size, _, h, _ in signed])]
            return _pairs(out)

        return step

    met = map_batches(both, check, PAIR, rows=64).withColumnsRenamed({"doc_id": "doc_text", "item_id": "item_text"})
    return met.join(left.select("doc_id", "doc_text"), "doc_text").join(right.select("item_id", "item_text"), "item_text").select(*(c.split()[0] for c in PAIR.split(", ")))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns.

    Found pairs are few; their documents' keys go out by an anti join on id and text hash.

    Null texts contain nothing and stay.  Very long texts are searched whole.  Repeated rows go or
    stay together.  No items or no documents: ``docs`` as it is.  Columns stay as they are, whatever
    their names.
    """
    found = contained_items(docs.select(F.xxhash64("doc_id", text_of()).alias("doc_id"), "text"), items)
    dirty = found.select(F.col("doc_id").alias("__sw_key")).distinct()
    return docs.withColumn("__sw_key", F.xxhash64("doc_id", text_of())).join(dirty, "__sw_key", "left_anti").select(*docs.columns)


def run(spark, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: The same pairs by brute force in SQL (DuckDB).
PAIR_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(text), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS r, item_id, regexp_extract_all(lower(text), '[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+') AS w FROM benchmark),
bs AS (SELECT DISTINCT r, item_id, least(5, len(w)) AS size, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT r, count(*) AS n FROM bs GROUP BY r),
ds AS (SELECT DISTINCT r, doc_id, size, array_to_string(w[i : i + size - 1], ' ') AS s
  FROM (SELECT d.*, z.size, unnest(range(1, len(w) - z.size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bs) z WHERE len(w) >= z.size))
SELECT ds.doc_id, bs.item_id, n.n AS n_shingles, count(*) AS n_shared, count(*) / n.n AS containment
FROM ds JOIN bs USING (size, s) JOIN n ON n.r = bs.r
GROUP BY ds.r, ds.doc_id, bs.r, bs.item_id, n.n HAVING count(*) >= 0.8 * n.n
"""
