"""Average-linkage clusters of vectors, for keys of any size.

Two clusters join while the mean distance of their members is within a limit, so some pair of them is,
and no cluster reaches beyond a connected component of the pairs within the limit.  A key of more than
``SMALL`` vectors is therefore cut into these components first, by Spark, and each component is
clustered by itself; the result is that of the whole key.

The pairs are sought in blocks.  Vectors go to the nearest of a key's pivots, and a block is a stretch of a
key's vectors in the order of their pivots.  Two pivots' vectors meet only if the pivots are no further apart
than the limit and both radii, as angles, and two blocks only if some of their pivots' do.  A group multiplies
two blocks and gives a forest of the links it finds.  Vectors that are in no link see no Python again, and
components stream through tasks, many in a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..graph import components
from ..shipping import ship, tasks
from ..storage import cut
from .intervals import KEYS, apart

#: Vectors of a key that one task clusters without looking for components.
SMALL = 4096
#: Vectors of a block, in the mean.
BLOCK = 8192
#: Rows of a block that are multiplied with another block at a time.
STRIP = 512
#: Pivots of a key, fewer where all keys' together would be over PIVOT_BYTES.
PIVOTS, PIVOT_BYTES = 64, 16 << 20


def by_key(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.Table]:
    """The rows of each key, of rows that stand by their first ``n`` columns; one key is held at a time."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        keys = list(zip(*(batch.column(i).to_pylist() for i in range(n)), strict=True)) if n else [()] * batch.num_rows
        first = 0
        for i in range(1, batch.num_rows + 1):
            if i < batch.num_rows and keys[i] == keys[first]:
                continue
            if held and keys[first] != now:
                yield pa.Table.from_batches(held)
                held = []
            now = keys[first]
            held.append(batch.slice(first, i - first))
            first = i
    if held:
        yield pa.Table.from_batches(held)


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in single precision; zero rows stay zero."""
    v = np.asarray(vectors, np.float32)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)


def linked_clusters(vectors: np.ndarray, most: float = 0.45, tie: float = 1e-9) -> list[list[int]]:
    """Average-linkage clusters under cosine distance, joined while some two are within ``most``.

    Of pairs within ``tie`` of the nearest the first by place joins, a cluster having its first member's.
    The mean of the products of two clusters' members is the product of their means, so a cluster is its
    sum and its size, and memory grows with the vectors alone.  Each cluster knows its nearest later one;
    a join looks again at those whose nearest was one of the two.
    """
    v = units(vectors).astype(np.float64) if len(vectors) else np.empty((0, 0))
    if not len(v):
        return []
    # Rows alike are one cluster from the beginning, as nothing is nearer.
    _, first, alike = np.unique(v, axis=0, return_index=True, return_inverse=True)
    alike = alike.reshape(-1)
    first = np.where(v.any(1), first[alike], np.arange(len(v)))
    start = np.unique(first)
    members = [[] for _ in start]
    for i, s in enumerate(np.searchsorted(start, first).tolist()):
        members[s].append(i)
    size = np.array([len(m) for m in members], np.float64)
    total = v[start] * size[:, None]
    alive = np.ones(len(start), bool)
    low, near = np.full(len(start), np.inf), np.full(len(start), -1)

    def look(rows: np.ndarray) -> None:
        """Each row's nearest later cluster."""
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            far = 1.0 - (total[part] @ total.T) / (size[part, None] * size)
            far[:, ~alive] = np.inf
            far[np.arange(len(start)) <= part[:, None]] = np.inf
            near[part] = far.argmin(1)
            low[part] = far[np.arange(len(part)), near[part]]

    look(np.arange(len(start)))
    for _ in range(len(start) - 1):
        least = low.min()
        if least > most:
            break
        a = int(np.argmax(low <= least + tie))
        far = 1.0 - (total[a + 1 :] @ total[a]) / (size[a + 1 :] * size[a])
        b = a + 1 + int(np.argmax(alive[a + 1 :] & (far <= least + tie)))
        members[a] += members[b]
        total[a] += total[b]
        size[a] += size[b]
        alive[b], low[b], members[b] = False, np.inf, []
        again = alive & ((near == a) | (near == b))
        again[a] = True
        look(np.flatnonzero(again))
        if a:
            far = 1.0 - (total[:a] @ total[a]) / (size[:a] * size[a])
            nearer = alive[:a] & (far < low[:a])
            low[:a][nearer], near[:a][nearer] = far[nearer], a
    return sorted(sorted(m) for m in members if m)


def forest(close: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) that join what the true cells of a matrix join, as few as can be."""
    free_r, free_c = close.any(1), np.ones(close.shape[1], bool)
    out = []
    while free_r.any():
        rows = np.array([int(np.argmax(free_r))])
        free_r[rows] = False
        while len(rows):
            part = close[rows]
            cols = np.flatnonzero(part.any(0) & free_c)
            out += zip(rows[part[:, cols].argmax(0)].tolist(), cols.tolist(), strict=True)
            free_c[cols] = False
            part = close[:, cols]
            rows = np.flatnonzero(part.any(1) & free_r) if len(cols) else cols
            if len(rows):
                out += zip(rows.tolist(), cols[part[rows].argmax(1)].tolist(), strict=True)
            free_r[rows] = False
    return out


def fewest(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Those of links that join what the links before them do not."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(p, p)
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def pivots_of(rows: DataFrame, k: list[str], n_keys: int) -> dict[tuple, np.ndarray]:
    """Some vectors of each key, by the hash of their ids; none where even one of each would be too much."""
    width = rows.agg(F.max(F.size("vector")).alias("n")).first()["n"] or 1
    each = min(PIVOTS, PIVOT_BYTES // (4 * width * n_keys))
    if not each:
        return {}
    order = W.partitionBy(*k).orderBy(F.xxhash64("__id"), "__id")
    chosen = rows.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= each).orderBy(*k, "__n").collect()
    out: dict[tuple, list] = {}
    for r in chosen:
        out.setdefault(tuple(r[c] for c in k), []).append(r["vector"])
    return {key: units(np.array(v, np.float32)).astype(np.float64) for key, v in out.items()}


def links(rows: DataFrame, keys: Sequence[str], n_keys: int, most: float) -> DataFrame:
    """Links (a, b) of ``__id`` that connect what pairs within ``most`` connect.

    ``rows``: keys, ``__id``, ``vector`` (floats, distinct within a key), as a written table.
    """
    k = list(keys)
    shared = rows.sparkSession.sparkContext.broadcast(pivots_of(rows, k, n_keys))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    at_keys, at_vector = [rows.columns.index(c) for c in k], rows.columns.index("vector")
    limit = math.acos(max(-1.0, min(1.0, 1 - most - 1e-9)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots = shared.value
        for batch in batches:
            cells, angles = np.zeros(batch.num_rows, np.int32), np.full(batch.num_rows, math.pi)
            of = list(zip(*(batch.column(i).to_pylist() for i in at_keys), strict=True))
            vectors = units(batch.column(at_vector).flatten().to_numpy().reshape(batch.num_rows, -1))
            where: dict[tuple, list[int]] = {}
            for i, key in enumerate(of):
                where.setdefault(key, []).append(i)
            for key, at in where.items():
                if key in pivots:
                    cosine = vectors[at].astype(np.float64) @ pivots[key].T
                    cells[at] = cosine.argmax(1)
                    angles[at] = np.arccos(np.clip(cosine.max(1), -1, 1))
            unit = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in [*k, "__id"]), unit, pa.array(cells), pa.array(angles)], [*k, "__id", "unit", "__cell", "__angle"])

    def near(key: tuple, cells: np.ndarray, radius: np.ndarray, others: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Whether vectors of a cell and of another one, within their radii, can be within the limit."""
        if key not in shared.value:
            return np.ones((len(cells), len(others)), bool)
        pivots = shared.value[key]
        return ~(np.arccos(np.clip(pivots[cells] @ pivots[others].T, -1, 1)) > limit + radius[:, None] + reach + 1e-6)

    def pair(table: pa.Table) -> pa.Table:
        """The pairs of a key's blocks that some near cells reach into."""
        cells, n, radius, first = (table.column(c).to_numpy() for c in ("__cell", "n", "radius", "first"))
        key = tuple(table.column(c)[0].as_py() for c in k)
        blocks = int((first + n - 1).max() // BLOCK) + 1
        wanted = np.zeros((blocks, blocks), bool)
        low, high = first // BLOCK, (first + n - 1) // BLOCK + 1
        for i, j in np.argwhere(near(key, cells, radius, cells, radius)).tolist():
            wanted[low[i] : high[i], low[j] : high[j]] = True
        a, b = np.nonzero(np.triu(wanted | wanted.T))
        return pa.table([*(pa.array([x] * len(a), table.schema.field(c).type) for c, x in zip(k, key, strict=True)), pa.array(a, pa.int64()), pa.array(b, pa.int64())], [*k, "block", "other"])

    def solve(table: pa.Table) -> pa.Table:
        key = tuple(table.column(c)[0].as_py() for c in k)
        ids, cells, angles, block = (table.column(c).to_numpy() for c in ("__id", "__cell", "__angle", "__at"))
        v = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float32).reshape(len(ids), -1)
        first, own = table.column("block")[0].as_py(), table.column("block")[0] == table.column("other")[0]
        order = np.argsort(cells, kind="stable")
        a = order[block[order] == first]
        b = a if own else order[block[order] != first]
        if not len(a) or not len(b):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        # In single precision a product is less exact by this; a link too many only makes a component larger.
        floor = np.float32(1 - most - 1e-9 - (v.shape[1] + 2) * 2.0**-23)
        (of_a, at_a), (of_b, at_b) = (np.unique(cells[x], return_index=True) for x in (a, b))
        meet = near(key, of_a, np.maximum.reduceat(angles[a], at_a), of_b, np.maximum.reduceat(angles[b], at_b))
        runs = [(0, len(a), None)] if meet.all() else [(x, y, np.repeat(m, np.diff(np.r_[at_b, len(b)]))) for x, y, m in zip(at_a.tolist(), [*at_a[1:].tolist(), len(a)], meet, strict=True)]
        left, right, far = v[a], v[b], []
        for begin, end, some in runs:
            for at in range(begin, end, STRIP):
                rows = np.arange(at, min(at + STRIP, end))
                # Of a block with itself each pair counts once.
                cols = np.arange(at if own else 0, len(b)) if some is None else np.flatnonzero(some & (np.arange(len(b)) >= at) if own else some)
                close = left[rows] @ (right[cols[0] :] if some is None else right[cols]).T >= floor if len(cols) else np.zeros((len(rows), 0), bool)
                if own:
                    inner = int(np.searchsorted(cols, rows[-1] + 1))
                    close[:, :inner] &= cols[:inner] > rows[:, None]
                found = np.flatnonzero(close)
                if len(found) > sum(close.shape):
                    found = np.array([r * len(cols) + c for r, c in forest(close)])
                far.append(np.stack([a[rows[found // len(cols)]], b[cols[found % len(cols)]]]) if len(found) else np.empty((2, 0), int))
        some = fewest(*np.concatenate(far, axis=1).tolist())
        return pa.table({"a": pa.array([ids[x] for x, _ in some], pa.int64()), "b": pa.array([ids[y] for _, y in some], pa.int64())})

    own = ", ".join(f"`{c}` {kind[c]}" for c in k)
    celled = cut(rows.mapInArrow(assign, f"{own}, __id {kind['__id']}, unit binary, __cell int, __angle double"))
    before = W.partitionBy(*k).orderBy("__cell").rowsBetween(W.unboundedPreceding, -1)
    cells = celled.groupBy(*k, "__cell").agg(F.count("*").alias("n"), F.max("__angle").alias("radius"))
    cells = cut(cells.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))))
    pairs = cells.groupBy(*k).applyInArrow(pair, f"{own}, block long, other long")
    wanted = cut(pairs.select("*", F.explode(F.array_distinct(F.array("block", "other"))).alias("__at")))
    place = F.col("first") + F.pmod(F.xxhash64("__id"), F.col("n"))
    dealt = celled.join(cells.select(*k, "__cell", "n", "first"), [*k, "__cell"]).withColumn("__at", F.floor(place / BLOCK)).drop("n", "first")
    met = dealt.join(wanted, [*k, "__at"]).repartition(tasks(rows.sparkSession), *k, "block", "other")
    return met.groupBy(*k, "block", "other").applyInArrow(solve, "a long, b long")


def cluster(vectors: DataFrame, keys: Sequence[str] = KEYS, item: str = "track_id", vector: str = "vector", most: float = 0.45) -> DataFrame:
    """``cluster`` number (from 0, by smallest item) of each item of a key.

    A key of more than ``SMALL`` vectors is cut into connected components, each clustered within one task, in
    memory that grows with its vectors.  Zero and null vectors are clusters by themselves.
    """
    k = list(keys)
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select(*k, item, F.col(vector).cast("array<float>").alias("vector"))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}

    def solve(n: int):
        """The clusters of rows that stand by their first ``n`` columns: ``item, first, place`` of each item."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: list[pa.Table] = []
            for table in by_key(batches, n):
                column = table.column("vector").combine_chunks()
                there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
                values = column.drop_null().flatten().to_numpy(zero_copy_only=False)
                data = np.zeros((len(column), len(values) // max(len(there), 1)), np.float32)
                if len({len(v) for v in column.drop_null()}) > 1:
                    raise ValueError("vectors of a key differ in length")
                data[there] = values.reshape(len(there), -1)
                groups = linked_clusters(data, most)
                where = np.empty(len(column), np.int32)
                for number, g in enumerate(groups):
                    where[g] = number
                first = table.column(item).take(pa.array([g[0] for g in groups])).take(pa.array(where))
                done.append(table.select([*k, item]).append_column("cluster", pa.array(where)).append_column("__first", first))
                if len(done) >= 256:
                    yield from pa.concat_tables(done).combine_chunks().to_batches()
                    done = []
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()

        return run

    def clustered(some: DataFrame, by: list[str]) -> DataFrame:
        return some.repartition(tasks(spark), *by).sortWithinPartitions(*by, item).select(*by, item, "vector").mapInArrow(solve(len(by)), schema)

    schema = ", ".join(f"`{n}` {kind[n]}" for n in [*k, item]) + f", cluster int, __first {kind[item]}"
    sizes = rows.groupBy(*k).count().where(F.col("count") > SMALL).drop("count")
    n_keys = sizes.count()
    if not n_keys:
        return clustered(rows, k).drop("__first")
    sizes = cut(sizes)
    small = clustered(rows.join(sizes, k, "left_anti"), k).drop("__first")
    large = cut(rows.join(sizes, k, "left_semi").withColumn("__id", F.monotonically_increasing_id()))
    # Of vectors alike one is sought.
    nonzero = F.exists("vector", lambda x: x != 0)
    alike = cut(large.where(nonzero).groupBy(*k, "vector").agg(F.min("__id").alias("__id"), F.min(item).alias("__first")))
    roots = components(links(alike.select(*k, "__id", "vector"), k, n_keys, most))
    rooted = alike.join(roots, alike["__id"] == roots["node"], "left").select(*k, "vector", "__first", F.col("root").alias("__root"))
    parts = large.join(rooted, [*k, "vector"], "left")
    # What is linked to nothing is a cluster with its copies.
    lone = parts.where("__root is null").select(*k, item, F.coalesce("__first", item).alias("__first"))
    linked = clustered(parts.where("__root is not null"), [*k, "__root"]).select(*k, item, "__first")
    number = F.dense_rank().over(W.partitionBy(*k).orderBy("__first")) - 1
    return small.unionByName(apart(lone).unionByName(apart(linked)).select(*k, item, number.alias("cluster")))
