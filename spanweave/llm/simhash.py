"""SimHash near-duplicates found by deletion-variant signatures.

Fingerprints of 64 bits link where at most four bits differ.  Cut into three segments, two linked
fingerprints have a segment in which at most one bit differs, so they agree on that segment with
one and the same bit left out.  Each fingerprint is indexed under all 64 such one-wildcard
variants; an equality join on the variant gives the candidates and the bits decide.

A variant's key holds 20 or 21 bits, so its members grow with the corpus.  Those of a key with more
than CROWD are indexed again, under the key and 42 or 43 one-wildcard variants of what the rest of
the fingerprint holds, cut in three (of at most four differing bits there, one third has at most
one): such keys hold 33 to 35 bits.  Members of keys that are still crowded are linked through balls
of two flips, and so are at once those of keys whose members have DENSE crowded keys or more each, as
groups of near copies do: for these a ball is less than so many variants.  So a fingerprint is at most
64 rows, about 2,100 more where its keys are crowded, and a ball of 2,081 where those are crowded
still; no key's pairs are all made beyond CROWD members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanweave.shipping import ship

from .common import cut, map_batches, n_partitions, release, table, text_of
from .components import components

#: Widths of the segments, lowest bits first.
SEGMENTS = (22, 21, 21)
BITS = 4
SHINGLE = 4
#: Fingerprints sharing one key beyond which they are not compared in pairs.
CROWD = 4096
#: Crowded keys of a fingerprint from which a ball has fewer rows than the variants under all of them.
DENSE = 2081 // 43
#: Widths of the thirds of what remains of a fingerprint without one of its segments.
THIRDS = (15, 14, 14)
#: Shingles hashed at a time.
BLOCK = 65_536


def fingerprint(text: str) -> int:
    """SimHash of a text's word shingles: see ``fingerprints``."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[: -SHINGLE])]
    digest, total, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(starts)
    for at in range(0, n, BLOCK):
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[at : at + BLOCK], ends[at + SHINGLE - 1 :], strict=False)), np.uint64)
        total += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` for each row: the SimHash of its whole text as a signed long.

    A-Z are lower-cased, words are runs of other than ASCII white space, shingles are four words
    joined by spaces, repeats included (fewer words: all of them).  A bit is 1 if set in over half
    of the shingles' XXH64 (seed 42).  Null and wordless texts: zero.  A row for each row; other
    columns are dropped.
    """

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            fp = np.array([fingerprint(t) for t in batch.column(2).to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fp.view(np.int64))], ["doc_id", "text_hash", "fp"])

        return step

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"))
    return map_batches(rows, make, "doc_id long, text_hash long, fp long")


def variants(fps: DataFrame) -> DataFrame:
    """``key, fp``: each fingerprint under its 64 one-wildcard segment variants.

    The key holds the segment with the wildcard bit cleared and the wildcard's position, which
    says the segment too.
    """
    keys, low = [], 0
    for width in SEGMENTS:
        segment = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << width) - 1))
        keys += [segment.bitwiseAND(F.lit(~(1 << i))) + F.lit((low + i) << 32) for i in range(width)]
        low += width
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def again(crowded: DataFrame) -> DataFrame:
    """``key, fp``: members of crowded keys (``key, fp``) under variants of the rest of their bits.

    Keys are hashed with the variant; members that meet by chance are told apart by their bits.
    """
    rest, low, keys = None, 0, []
    for width in SEGMENTS:
        own = F.shiftrightunsigned("fp", low + width) if low + width < 64 else F.lit(0).cast("long")
        own = F.shiftleft(own, low).bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << low) - 1))) if low else own
        bit = F.shiftright("key", 32)
        rest = F.when((bit >= low) & (bit < low + width), own) if rest is None else rest.when((bit >= low) & (bit < low + width), own)
        low += width
    low = 0
    for width in THIRDS:
        third = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << width) - 1))
        keys += [F.xxhash64("key", F.lit(low + i), third.bitwiseAND(F.lit(~(1 << i)))) for i in range(width)]
        low += width
    return crowded.select("key", "fp", rest.alias("rest")).select(F.explode(F.array(*keys)).alias("key"), "fp")


def linked(crowd: int):
    """The function that links sorted (key, fp) rows, comparing no key's pairs beyond ``crowd`` members."""
    return lambda batches: _linked(batches, crowd)


def _linked(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Links among sorted (key, fp) rows, and the members of crowded keys as (fp, null, key).

    Of the pairs within BITS only those are returned that join two groups not joined before in
    this task, so the rows returned are fewer than the fingerprints met.  A key's rows are held
    until it has more than ``most``.
    """
    release()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(p, p)
        return x

    def solve(keys: np.ndarray, fps: np.ndarray) -> tuple[list[int], list[int]]:
        a, b = [], []
        words = fps.view(np.uint64)
        at = np.flatnonzero(keys[1:] == keys[:-1])
        shared = np.union1d(at, at + 1)
        distinct = np.unique(fps[shared])
        where = np.zeros(len(fps), np.int64)
        where[shared] = np.searchsorted(distinct, fps[shared])
        group = np.arange(len(distinct))  # joined so far in this call, so that dense groups are cheap
        shift = 1
        while len(at):
            close = at[group[where[at]] != group[where[at + shift]]]
            close = close[np.bitwise_count(words[close] ^ words[close + shift]) <= BITS]
            for x, y in zip(fps[close].tolist(), fps[close + shift].tolist(), strict=True):
                if (p := root(x)) != (q := root(y)):
                    parent[max(p, q)] = min(p, q)
                    a.append(x)
                    b.append(y)
            if len(close):
                joined = np.unique(np.concatenate([where[close], where[close + shift]]))
                to = {}
                for i in joined.tolist():
                    to.setdefault(root(int(distinct[i])), []).append(group[i])
                swap = np.arange(len(distinct))
                for old in to.values():
                    swap[old] = min(old)
                group = swap[group]
            shift += 1
            at = at[at + shift < len(keys)]
            at = at[keys[at] == keys[at + shift]]
        return a, b

    names = ["a", "b", "key"]
    pack = lambda a, b: pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.nulls(len(a), pa.int64())], names)
    full = lambda k, f: pa.RecordBatch.from_arrays([pa.array(f), pa.nulls(len(f), pa.int64()), pa.array(k)], names)

    def settle(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Links of whole keys; keys that turned out crowded are told apart first."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        over = np.repeat(sizes > most, sizes)
        if over.any():
            yield full(keys[over], fps[over])
        a, b = solve(keys[~over], fps[~over])
        if a:
            yield pack(a, b)

    held_k, held_f, crowd = np.empty(0, np.int64), np.empty(0, np.int64), None
    for batch in batches:
        k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if crowd is not None:
            more = int(np.searchsorted(k, crowd, "right")) if k[0] == crowd else 0
            if more:
                yield full(k[:more], f[:more])
            if more == len(k):
                continue
            k, f, crowd = k[more:], f[more:], None
        held_k, held_f = np.concatenate([held_k, k]), np.concatenate([held_f, f])
        last = int(np.searchsorted(held_k, held_k[-1], "left"))
        if len(held_k) - last > most:
            crowd = held_k[-1]
            yield full(held_k[last:], held_f[last:])
            held_k, held_f = held_k[:last], held_f[:last]
        if last:
            yield from settle(held_k[:last], held_f[:last])
            held_k, held_f = held_k[last:], held_f[last:]
    if len(held_k):
        yield from settle(held_k, held_f)


def balls(fps: DataFrame) -> DataFrame:
    """Links among fingerprints that crowd one variant, linear in their number.

    Two fingerprints differ in at most four bits exactly when some word differs from each in at
    most two, so all that reach one word by at most two flips are linked to the smallest of them.
    """
    flips = [0, *(1 << i for i in range(64)), *(1 << i | 1 << j for i in range(64) for j in range(i))]
    flips = [x - (1 << 64) if x >> 63 else x for x in flips]
    reached = fps.select(F.explode(F.lit(flips)).alias("flip"), "fp").select(F.col("fp").bitwiseXOR(F.col("flip")).alias("word"), "fp")
    least = reached.groupBy("word").agg(F.min("fp").alias("least"), F.max("fp").alias("most")).where("least <> most")
    return reached.join(least, "word").where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def links(fps: DataFrame, crowd: int = CROWD, dense: int = DENSE) -> DataFrame:
    """Links (a, b) that connect just the distinct fingerprints ``fp`` that links of BITS connect."""
    spark = fps.sparkSession
    ship(spark)
    width = max(n_partitions(spark), 3 * spark.sparkContext.defaultParallelism)

    def search(keyed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """Links, and the members of crowded keys if any."""
        found = cut(keyed.repartition(width, "key").sortWithinPartitions("key").mapInArrow(linked(crowd), "a long, b long, key long"))
        over = found.where("b is null").select("key", F.col("a").alias("fp")).distinct()
        return found.where("b is not null").select("a", "b"), None if over.isEmpty() else over

    pairs, over = search(variants(fps))
    if over is None:
        return pairs
    # A key is settled whole in one way or the other, so no pair of its members is missed.
    over = cut(over)
    held = over.groupBy("fp").agg(F.count("*").alias("c"))
    thick = cut(over.join(held, "fp").groupBy("key").agg(F.avg("c").alias("c")).where(F.col("c") >= dense).select("key"))
    whole = over.join(thick, "key", "left_semi").select("fp")
    more, still = search(again(over.join(thick, "key", "left_anti")))
    whole = cut((whole if still is None else whole.union(still.select("fp"))).distinct())
    pairs = pairs.union(more)
    return pairs if whole.isEmpty() else pairs.union(balls(whole))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp, root, component_id`` for each row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most four differing bits,
    itself included (null only where all of a component's ids are); root is the component's smallest
    fingerprint, which names it also then.  Equal fingerprints count
    once in the search, however many rows have them.  Null, empty and wordless texts have
    fingerprint zero and are linked like any other.  Empty table: empty result.
    """
    prints = cut(fingerprints(docs))
    fps = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(fps.select("fp")))
    joined = cut(fps.join(roots, fps.fp == roots.node, "left").select("fp", "least_id", "root"))
    # A table of its own, so that adaptive execution may split the join at a root of very many.
    named = cut(joined.where("root is not null").groupBy("root").agg(F.min("least_id").alias("component_id")))
    member = joined.join(named, "root", "left")
    member = member.select("fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("component_id")).alias("component_id"))
    return prints.join(member, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id, of those with it that of the smallest text hash.

    A component all of whose ids are null keeps one row too, and so does each of several such.  Rows alike
    in id and text are one.  Null, empty and wordless texts are one component, as their fingerprints are
    equal.  Empty table: empty result.  All columns stay as they are, whatever their names.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("__sw_id"), F.col("text_hash").alias("__sw_hash")))
    kept = near_duplicates(docs).groupBy("root").agg(first.alias("kept")).select("kept.__sw_id", "kept.__sw_hash")
    keyed = docs.withColumn("__sw_id", F.col("doc_id").cast("long")).withColumn("__sw_hash", F.xxhash64(text_of()))
    on = keyed["__sw_id"].eqNullSafe(kept["__sw_id"]) & (keyed["__sw_hash"] == kept["__sw_hash"])
    return keyed.join(kept, on, "left_semi").dropDuplicates(["__sw_id", "__sw_hash"]).drop("__sw_id", "__sw_hash")


def run(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
