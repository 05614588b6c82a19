"""Half-open interval algebra over tables: keys, ``start``, ``end``.

All operators take key columns (default ``video_id``), use windows and equality joins on the keys,
and run wholly in the JVM.  Rows with a null bound, and rows without positive length where noted,
are dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ("video_id",)


def overlap_length(a_start, a_end, b_start, b_end):
    """Length that two intervals share, 0 where they are apart."""
    return F.greatest(F.lit(0), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def contains(start, end, t):
    """Whether ``t`` is in [start, end)."""
    return (start <= t) & (t < end)


def checked(df: DataFrame) -> DataFrame:
    """``df``, failing on a row whose end is before its start."""
    bad = F.raise_error(F.format_string("interval ends before it starts: %s, %s", F.col("start").cast("string"), F.col("end").cast("string")))
    return df.withColumn("end", F.when(F.col("end") < F.col("start"), bad).otherwise(F.col("end")))


def islands(df: DataFrame, keys: Sequence[str] = KEYS, max_gap=0) -> DataFrame:
    """``df`` with ``island``, numbering runs of intervals whose gaps are at most ``max_gap``."""
    order = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("start") - reach > max_gap), 1).otherwise(0)
    return df.where("start is not null and end is not null").withColumn("__new", new).withColumn("island", F.sum("__new").over(order)).drop("__new")


def merge(df: DataFrame, keys: Sequence[str] = KEYS, max_gap=0) -> DataFrame:
    """Intervals of each key merged where the gap between them is at most ``max_gap`` (closed)."""
    return islands(df, keys, max_gap).groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def union_length(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Length that the intervals of each key cover."""
    return merge(df, keys).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("length"))


def apart(df: DataFrame) -> DataFrame:
    """``df`` as it is, but to the planner of no known partitioning.

    Spark 4.1 unites sides of one partitioning partition by partition (spark.sql.unionOutputPartitioning),
    and where both read one reused exchange rows of a side are lost.  A side of a union passes here
    first, which only nests and unnests its columns.
    """
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("__row")).select("__row.*")


def bounds(df: DataFrame, keys: Sequence[str], **steps) -> DataFrame:
    """Both bounds of each interval as rows ``t``; ``steps`` name columns that are the step (a number or column) at
    its start and less that at its end.
    """
    row = lambda at, sign: F.struct(F.col(at).alias("t"), *[F.lit(sign * step).alias(name) for name, step in steps.items()])
    return df.select(*keys, F.explode(F.array(row("start", 1), row("end", -1))).alias("__b")).select(*keys, "__b.*")


def swept(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Spans between the bounds of both sides, with whether left (``l``) and right (``r``) cover them, and whether a
    merged interval without length of one side is at their start, inside one of the other (``inner``).

    Either side is merged first; one window pass over the bounds, so no pairs are made.
    """
    point = (F.col("start") == F.col("end")).cast("int")
    events = apart(bounds(merge(a, keys), keys, l=1, r=0, lp=point, rp=0)).unionByName(apart(bounds(merge(b, keys), keys, l=0, r=1, lp=0, rp=point)))
    steps = events.groupBy(*keys, "t").agg(*[f(c).alias(c) for c, f in (("l", F.sum), ("r", F.sum), ("lp", F.max), ("rp", F.max))])
    order = W.partitionBy(*keys).orderBy("t")
    covers = lambda c: F.sum(c).over(order) > 0
    # Merged intervals do not touch, so what covers before and after a point holds it.
    holds = lambda c: covers(c) & (F.sum(c).over(order) - F.col(c) > 0)
    inner = ((F.col("lp") > 0) & holds("r")) | ((F.col("rp") > 0) & holds("l"))
    return steps.select(*keys, F.col("t").alias("start"), F.lead("t").over(order).alias("end"), covers("l").alias("l"), covers("r").alias("r"), inner.alias("inner")).where("end > start")


def shared(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS, points: bool = False) -> DataFrame:
    """Spans between bounds that both sides cover; with ``points`` also, as spans without length, the merged
    intervals without length of one side that are inside one of the other.
    """
    met = swept(a, b, keys).where("(l and r) or inner" if points else "l and r")
    return met.select(*keys, "start", F.when(F.col("l") & F.col("r"), F.col("end")).otherwise(F.col("start")).alias("end"))


def intersect(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS, points: bool = False) -> DataFrame:
    """Maximal spans of positive length that both sides cover, and ``points`` if asked for."""
    return merge(shared(a, b, keys, points), keys)


def overlap_total(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS, points: bool = False) -> DataFrame:
    """Length that both sides cover, for each key where they do; with ``points`` 0 where they share these alone."""
    return shared(a, b, keys, points).groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("length"))


def owner_overlap(df: DataFrame, owner: str, first, second, keys: Sequence[str] = KEYS, points: bool = False) -> DataFrame:
    """Length that two named owners share, for each key where they do (or, with ``points``, meet)."""
    return overlap_total(df.where(F.col(owner) == first), df.where(F.col(owner) == second), keys, points)


def subtract(a: DataFrame, b: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """What the left side covers and the right side does not."""
    return merge(swept(a, b, keys).where("l and not r").select(*keys, "start", "end"), keys)


def depth(df: DataFrame, owner: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Spans between bounds with how many distinct owners are active in each.

    Owners' own intervals are merged first, so each counts once; intervals without length are
    dropped, which a sweep that closes before it opens would leave open for ever.
    """
    own = merge(df.where("end > start"), [*keys, owner])
    steps = bounds(own, keys, d=1).groupBy(*keys, "t").agg(F.sum("d").alias("d"))
    order = W.partitionBy(*keys).orderBy("t")
    return steps.select(*keys, F.col("t").alias("start"), F.lead("t").over(order).alias("end"), F.sum("d").over(order).alias("owners")).where("end is not null")


def overlaps(df: DataFrame, owner: str, keys: Sequence[str] = KEYS, least: int = 2) -> DataFrame:
    """Maximal spans in which ``least`` distinct owners or more are active."""
    return merge(depth(df, owner, keys).where(F.col("owners") >= least).select(*keys, "start", "end"), keys)


def clamp(df: DataFrame, limit, floor=0) -> DataFrame:
    """Intervals cut to [floor, limit]; what is left without length goes."""
    cut = df.withColumn("start", F.least(F.greatest("start", F.lit(floor)), limit)).withColumn("end", F.least(F.greatest("end", F.lit(floor)), limit))
    return cut.where("end > start")


def tile(cuts: DataFrame, spans: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Spans tiled at the cuts inside them: keys, ``index`` from 1, ``start``, ``end``.

    ``cuts`` has ``t``; cuts outside a span's inside and repeated cuts do not count.
    """
    whole = spans.select(*keys, "start", "end")
    inside = cuts.join(whole, list(keys)).where("t > start and t < end").select(*keys, "t")
    times = apart(inside).unionByName(bounds(whole, keys)).distinct()
    order = W.partitionBy(*keys).orderBy("t")
    return times.select(*keys, F.row_number().over(order).alias("index"), F.col("t").alias("start"), F.lead("t").over(order).alias("end")).where("end is not null")


def presence(sightings: DataFrame, keys: Sequence[str] = KEYS, single=0.1) -> DataFrame:
    """One span for each key from its sightings' times ``t``.

    It ends the typical gap after the last sighting: of the sorted gaps the one in the middle, the
    upper of two.  One sighting lasts ``single``.
    """
    order = W.partitionBy(*keys).orderBy("t")
    gaps = sightings.select(*keys, "t", (F.lead("t").over(order) - F.col("t")).alias("gap"))
    found = gaps.groupBy(*keys).agg(F.min("t").alias("start"), F.max("t").alias("last"), F.array_sort(F.collect_list("gap")).alias("gaps"))
    tail = F.when(F.size("gaps") > 0, F.get("gaps", F.expr("cast(size(gaps) div 2 as int)"))).otherwise(F.lit(single))
    return found.select(*keys, "start", (F.col("last") + tail).alias("end"))


def within(spans: DataFrame, windows: DataFrame, keys: Sequence[str], window_keys: Sequence[str] = KEYS) -> DataFrame:
    """The spans of each key clipped to the windows (``index, start, end``) of its video that they meet.

    Windows are looked up by buckets of their typical length, so a long timeline is not one join key.
    """
    width = windows.agg(F.avg(F.col("end") - F.col("start")).alias("w")).first()["w"]
    if not width:
        return spans.limit(0).select(*keys, F.lit(0).alias("index"), "start", "end")
    cells = lambda s, e: F.explode(F.sequence(F.floor(s / width), F.floor(e / width)))
    left = spans.where("end > start").select(*keys, "start", "end", cells(F.col("start"), F.col("end")).alias("__cell"))
    right = windows.where("end > start").select(*window_keys, "index", F.col("start").alias("__s"), F.col("end").alias("__e"), cells(F.col("start"), F.col("end")).alias("__cell"))
    both = left.join(right, [*window_keys, "__cell"]).where("start < __e and __s < end")
    both = both.where(F.col("__cell") == F.floor(F.greatest("start", "__s") / width))
    return both.select(*keys, "index", F.greatest("start", "__s").alias("start"), F.least("end", "__e").alias("end"))
