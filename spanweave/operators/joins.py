"""Joins on time: overlap, membership, as-of, nearest, filled grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import KEYS, apart, bounds, merge


#: Levels of dyadic cells: lengths from 2^-30 on; shorter intervals are in cells of that size.
LEAST_LEVEL = -30


def overlap_join(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Pairs of rows whose intervals share time; b's bounds come as ``b_start, b_end``.

    Of two intervals that overlap the one holds where the other starts.  An interval is in the two or three
    cells that cover it of the size 2^level next below its own length; a start is in one cell of each
    level that the other side's intervals have.  So a pair meets in one cell, whatever the lengths,
    intervals are few rows each, starts one for each level (as many as lengths have powers of two), and
    rows that meet are within a few lengths of one another.  The levels are looked up first, by a pass over
    both sides' bounds.  Rows without both bounds overlap nothing; those without length only what holds them.
    """
    right = b.withColumnsRenamed({"start": "b_start", "end": "b_end"})
    level = lambda s, e: F.greatest(F.floor(F.log2(F.col(e).cast("double") - F.col(s).cast("double"))).cast("int"), F.lit(LEAST_LEVEL))
    known = lambda df, s, e: df.where(f"{e} > {s}").select(level(s, e).alias("n")).distinct().collect()
    levels = {side: sorted(r["n"] for r in known(df, s, e)) for side, df, s, e in (("a", a, "start", "end"), ("b", right, "b_start", "b_end"))}
    cell = lambda t, n: F.floor(F.col(t).cast("double") / F.pow(F.lit(2.0), n)).cast("long")

    def dealt(df: DataFrame, s: str, e: str, of_spans: int, others: list[int]) -> DataFrame:
        n = level(s, e)
        spans = F.when(F.col(e) > F.col(s), F.transform(F.sequence(cell(s, n), cell(e, n)), lambda c: F.struct(n.alias("level"), c.alias("cell"), F.lit(of_spans).alias("role"))))
        empty = F.array().cast("array<struct<level:int,cell:bigint,role:int>>")
        starts = F.array(*[F.struct(F.lit(i).alias("level"), cell(s, F.lit(i)).alias("cell"), F.lit(1 - of_spans).alias("role")) for i in others]) if others else empty
        rows = df.where(F.col(s).isNotNull() & F.col(e).isNotNull()).withColumn("__at", F.explode(F.concat(F.coalesce(spans, empty), starts)))
        return rows.withColumns({f"__{c}": F.col(f"__at.{c}") for c in ("level", "cell", "role")}).drop("__at")

    on = [*keys, "__level", "__cell", "__role"]
    both = dealt(a, "start", "end", 0, levels["b"]).join(dealt(right, "b_start", "b_end", 1, levels["a"]), on)
    holds = F.when(F.col("__role") == 0, F.col("b_start") >= F.col("start")).otherwise(F.col("start") > F.col("b_start"))
    return both.where(holds & F.expr("start < b_end and b_start < end")).drop("__level", "__cell", "__role")


def inside(points: DataFrame, spans: DataFrame, keys: Sequence[str] = KEYS, how: str = "left_semi") -> DataFrame:
    """Points ``t`` that are (left_semi) or are not (left_anti) in any [start, end)."""
    right = merge(spans.where("end > start"), keys).select(*keys, F.col("start").alias("t"), F.col("end").alias("__until"))
    hit = F.coalesce(F.col("t") < F.col("__until"), F.lit(False))
    return as_of(points, right, "__until", keys).where(hit if how == "left_semi" else ~hit).drop("__until")


def held(points: DataFrame, spans: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Points ``t`` that some span of its key holds with its inside: it starts before and ends after them."""
    rises, falls = F.when(F.col("d") > 0, F.col("d")), F.when(F.col("d") < 0, F.col("d"))
    steps = bounds(spans.where("end > start"), keys, d=1).groupBy(*keys, "t").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in (("up", rises), ("down", falls))])
    depth = F.sum(F.col("up") + F.col("down")).over(W.partitionBy(*keys).orderBy("t"))
    steps = steps.select(*keys, "t", F.struct(F.col("t").alias("at"), (depth - F.col("up")).alias("on"), depth.alias("after")).alias("__bound"))
    found = as_of(points, steps, "__bound", keys)
    return found.where(F.when(F.col("__bound.at") == F.col("t"), F.col("__bound.on")).otherwise(F.col("__bound.after")) > 0).drop("__bound")


def covered_before(points: DataFrame, spans: DataFrame, keys: Sequence[str] = KEYS, parts: int | None = None) -> DataFrame:
    """``points`` with ``covered``: how long the spans of its key last before its time ``t``, spans that
    lie over one another counting each.

    The spans' depth and its sum up to each bound come from one window pass; points then take the
    last bound's, so no pairs are made.  What spans cover from s to e is the difference at e and s.
    """
    steps = bounds(spans.where("end > start"), keys, d=1)
    steps = (steps.repartition(parts, *keys) if parts else steps).groupBy(*keys, "t").agg(F.sum("d").alias("d"))
    order = W.partitionBy(*keys).orderBy("t")
    steps = steps.select(*keys, "t", F.sum("d").over(order).alias("__depth"), F.lead("t").over(order).alias("__next"))
    whole = F.coalesce(F.sum(F.col("__depth") * (F.col("__next") - F.col("t"))).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    steps = steps.select(*keys, "t", F.struct(F.col("t").alias("at"), F.col("__depth").alias("depth"), whole.alias("sum")).alias("__bound"))
    found = as_of(points, steps, "__bound", keys, parts=parts)
    return found.withColumn("covered", F.coalesce(F.col("__bound.sum") + F.col("__bound.depth") * (F.col("t") - F.col("__bound.at")), F.lit(0))).drop("__bound")


def covered_within(rows: DataFrame, spans: DataFrame, keys: Sequence[str] = KEYS, name: str = "covered", parts: int | None = None) -> DataFrame:
    """``rows`` (start, end) with ``name``: how long the spans of their key last inside them; ``parts`` as in ``as_of``."""
    cols = rows.columns
    ends = rows.select("*", F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit(-1).alias("sign")), F.struct(F.col("end").alias("t"), F.lit(1).alias("sign")))).alias("__end"))
    ends = ends.select(*cols, F.col("__end.t").alias("t"), F.col("__end.sign").alias("__sign"))
    found = covered_before(ends, spans, keys, parts).groupBy(*cols).agg(F.sum(F.col("covered") * F.col("__sign")).alias("__c"), F.count("*").alias("__n"))
    # Rows alike in all columns are one group: each is given back.
    each = found.withColumn("__i", F.explode(F.expr("sequence(1, cast(__n div 2 as int))")))
    return each.select(*cols, (F.col("__c") / (F.col("__n") / 2)).cast(found.schema["__c"].dataType).alias(name))


def as_of(left: DataFrame, right: DataFrame, value: str, keys: Sequence[str] = KEYS, first_if_none: bool = False, parts: int | None = None) -> DataFrame:
    """``left`` with the ``value`` of the last right row at or before its time ``t``.

    One sort of both sides together carries the last value forward, so no pairs are made; of right
    rows at one time the greatest value counts.  ``first_if_none``: before all right rows, the
    first one's value.  ``parts``: into how many tasks the keys are dealt, where what Spark makes
    of the compressed size of rows alike would be too few.
    """
    cols = [c for c in left.columns if c not in keys and c != "t"]
    l_side = left.select(*keys, "t", F.struct(*cols).alias("__row"), F.lit(None).cast(right.schema[value].dataType).alias("__v"), F.lit(1).alias("__side"))
    r_side = right.groupBy(*keys, "t").agg(F.max(value).alias("__v")).select(*keys, "t", F.lit(None).cast(l_side.schema["__row"].dataType).alias("__row"), "__v", F.lit(0).alias("__side"))
    order = W.partitionBy(*keys).orderBy("t", "__side")
    found = F.last("__v", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    if first_if_none:
        found = F.coalesce(found, F.first("__v", ignorenulls=True).over(order.rowsBetween(0, W.unboundedFollowing)))
    both = apart(l_side).unionByName(apart(r_side))
    both = (both.repartition(parts, *keys) if parts else both).withColumn(value, found)
    return both.where("__side = 1").select(*keys, "t", *[F.col("__row")[c].alias(c) for c in cols], value)


def nearest(left: DataFrame, right: DataFrame, value: str, tolerance, keys: Sequence[str] = KEYS, row_id: str = "row_id") -> DataFrame:
    """``left`` with the ``value`` at the right time nearest to ``t`` within ``tolerance``, else null.

    Of two equally near the earlier counts.  Left rows are told apart by ``row_id``.  The sides are
    joined on key and a bucket of twice the tolerance, so a long timeline is not one join key.
    """
    width = 2 * tolerance
    r = right.select(*keys, F.col("t").alias("__rt"), F.col(value).alias("__v"))
    r = r.withColumn("__bucket", F.explode(F.array(*[F.floor((F.col("__rt") + d) / width) for d in (-tolerance, tolerance)]))).distinct()
    l_side = left.withColumn("__bucket", F.floor(F.col("t") / width))
    near = l_side.join(r, [*keys, "__bucket"], "left").withColumn("__far", F.abs(F.col("__rt") - F.col("t")))
    best = F.min_by(F.when(F.col("__far") <= tolerance, F.col("__v")), F.when(F.col("__far") <= tolerance, F.struct("__far", "__rt")))
    return near.groupBy(*left.columns).agg(best.alias(value))


def filled_grid(grid: DataFrame, seen: DataFrame, value: str, at: str = "frame", keys: Sequence[str] = KEYS, by: str | None = None, last: bool = True) -> DataFrame:
    """The grid with ``value`` where seen, carried forward, and back at the beginning.

    Of several values of one frame the last in the order of ``by`` counts, or the first; without
    ``by`` the greatest.
    """
    pick = F.max(value) if by is None else F.max_by(value, by) if last else F.min_by(value, by)
    one = seen.groupBy(*keys, at).agg(pick.alias(value))
    order = W.partitionBy(*keys).orderBy(at)
    found = F.coalesce(F.last(value, ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)), F.first(value, ignorenulls=True).over(order.rowsBetween(0, W.unboundedFollowing)))
    return grid.join(one, [*keys, at], "left").withColumn(value, found)


def missing(expected: DataFrame, seen: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Expected keys that nothing was seen of."""
    return expected.join(seen, list(keys), "left_anti")
