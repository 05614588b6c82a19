"""From speaker turns to segments, their sources, windows and languages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import KEYS, apart, clamp, depth, intersect, merge, union_length
from .joins import covered_within, held


def clean_turns(turns: DataFrame, limit, keys: Sequence[str] = KEYS, owner: str = "speaker", merge_gap=0.2, least=0.1, floor=0) -> DataFrame:
    """Turns clamped to the video, merged for each speaker, and those shorter than ``least`` dropped."""
    cut = clamp(turns, limit, floor).select(*keys, owner, "start", "end")
    return merge(cut, [*keys, owner], merge_gap).where(F.col("end") - F.col("start") >= least)


def turn_counts(turns: DataFrame, limit, keys: Sequence[str] = KEYS, owner: str = "speaker", merge_gap=0.2, least=0.1, floor=0) -> DataFrame:
    """What ``clean_turns`` does to each video's turns: raw, outside the video, clamped, merged, dropped as
    too short, and left.
    """
    k = list(keys)
    raw = turns.groupBy(*k).agg(F.count("*").alias("raw_turns"))
    cut = clamp(turns, limit, floor).select(*k, owner, "start", "end")
    left = merge(cut, [*k, owner], merge_gap).groupBy(*k).agg(F.count("*").alias("merged_turns"), F.count_if(F.col("end") - F.col("start") < least).alias("dropped_short"))
    found = raw.join(cut.groupBy(*k).agg(F.count("*").alias("clamped_turns")), k, "left").join(left, k, "left").na.fill(0)
    return found.withColumns({"outside_video": F.col("raw_turns") - F.col("clamped_turns"), "turns": F.col("merged_turns") - F.col("dropped_short")})


def speech_summary(turns: DataFrame, keys: Sequence[str] = KEYS, owner: str = "speaker") -> DataFrame:
    """Speakers, speech (union), speaker (sum) and overlap lengths, and overlap as a share of speech."""
    own = merge(turns.where("end > start").select(*keys, owner, "start", "end"), [*keys, owner])
    length = F.col("end") - F.col("start")
    by_owner = own.groupBy(*keys).agg(F.countDistinct(owner).alias("speakers"), F.sum(length).alias("speaker_length"))
    swept = depth(own, owner, keys).groupBy(*keys).agg(
        F.sum(F.when(F.col("owners") >= 1, length).otherwise(0)).alias("speech_length"), F.sum(F.when(F.col("owners") >= 2, length).otherwise(0)).alias("overlap_length")
    )
    ratio = F.when(F.col("speech_length") > 0, F.col("overlap_length") / F.col("speech_length")).otherwise(0.0)
    return by_owner.join(swept, list(keys)).withColumn("overlap_ratio", ratio)


def segments(speech: DataFrame, limit, keys: Sequence[str], voiced: DataFrame | None = None, voiced_keys: Sequence[str] = KEYS, max_gap=0.2, pad=0.05, least=0.3, short=0.5, floor=0) -> DataFrame:
    """Speech segments of each key: merged, bounded by voice activity, padded, and short ones flagged.

    ``limit`` is a column or number that caps ends; padded starts do not go below ``floor``.
    Durations are tested after padding: shorter than ``least`` go, shorter than ``short`` are flagged.
    """
    found = merge(speech, keys)
    if voiced is not None:
        spread = found.select(*keys).distinct().join(merge(voiced, voiced_keys), list(voiced_keys))
        found = intersect(found, spread, keys)
    found = merge(found, keys, max_gap)
    padded = found.withColumn("start", F.greatest(F.col("start") - pad, F.lit(floor))).withColumn("end", F.least(F.col("end") + pad, limit))
    length = F.col("end") - F.col("start")
    return merge(padded, keys).where(length >= least).withColumn("short", length < short)


def named(segs: DataFrame, keys: Sequence[str], identity: str) -> DataFrame:
    """Segments numbered from 0 within their identity and named like ``F001_0000``."""
    order = W.partitionBy(*keys, identity).orderBy("start", "end")
    found = segs.withColumn("index", F.row_number().over(order) - 1)
    return found.withColumn("name", F.format_string("%s_%04d", F.col(identity).cast("string"), F.col("index")))


def route_sources(segs: DataFrame, limit, keys: Sequence[str] = KEYS, identity: str = "speaker", least=0.1, context=0.25) -> DataFrame:
    """Where each segment is read from: extraction where others talk over it, else the mix with context.

    The overlap is a sum over others' segments, so two others at once count twice: what all segments
    cover of it less its own length.  Segments of one identity do not overlap, as ``segments`` makes them.
    """
    own = [*keys, identity, "start", "end"]
    found = covered_within(segs.select(*own), segs, keys, "__all").withColumn("overlap", F.col("__all") - (F.col("end") - F.col("start")))
    lo, hi = F.greatest(F.lit(0), F.col("start") - context), F.least(limit, F.col("end") + context)
    past = hi <= F.col("start")
    taken = F.col("overlap") >= least
    return found.select(
        *own,
        "overlap",
        F.when(taken, "extraction").otherwise("mix").alias("source"),
        F.when(taken | past, F.col("start")).otherwise(lo).alias("origin"),
        F.when(taken | past, F.col("end")).otherwise(hi).alias("until"),
    )


def frame_windows(videos: DataFrame, keys: Sequence[str] = KEYS, seconds=8.0, overlap=1.0, most=200) -> DataFrame:
    """Overlapping windows over the frames of each video (``duration, fps``), the last cut to its end."""
    total = F.greatest(F.lit(1), F.bround(F.col("duration") * F.col("fps"))).cast("int")
    width = F.least(F.greatest(F.lit(1), F.bround(F.lit(seconds) * F.col("fps")).cast("int")), F.lit(most))
    step = F.greatest(F.lit(1), F.col("__width") - F.greatest(F.lit(0), F.bround(F.lit(overlap) * F.col("fps")).cast("int")))
    base = videos.select(*keys, "fps", total.alias("__total"), width.alias("__width")).withColumn("__step", step)
    last = F.greatest(F.lit(0), F.ceil((F.col("__total") - F.col("__width")) / F.col("__step"))).cast("int")
    cut = base.select("*", F.posexplode(F.sequence(F.lit(0), last)).alias("index", "__i"))
    start = F.col("__i") * F.col("__step")
    return cut.select(*keys, "index", start.alias("start"), F.least(start + F.col("__width"), F.col("__total")).alias("end"))


def stitch(scores: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean of each frame's probability over the windows that hold it (``start``, array ``probs``)."""
    frames = scores.select(*keys, "start", F.posexplode("probs").alias("i", "p"))
    return frames.groupBy(*keys, (F.col("start") + F.col("i")).alias("frame")).agg(F.avg("p").alias("probability"))


def context_speakers(activity: DataFrame, keys: Sequence[str], identity: str, most: int = 3, points: bool = False) -> DataFrame:
    """For each identity the others active with it, most overlap first, at most ``most - 1``.

    Each span meets each other identity once, not each of its spans.  With ``points`` those are active with it
    too, with an overlap of 0, that it meets only in spans without length, of either, inside one of the other.
    """
    others = activity.select(*keys, F.col(identity).alias("other")).distinct()
    pairs = activity.select(*keys, identity, "start", "end").join(others, list(keys)).where(f"{identity} <> other")
    theirs = activity.select(*keys, F.col(identity).alias("other"), "start", "end")
    rows = covered_within(pairs, theirs, [*keys, "other"], "__c").select(*keys, identity, "other", "__c", F.lit(False).alias("__met"))
    if points:
        alone = pairs.where("start = end").select(*keys, identity, "other", F.col("start").alias("t")).distinct()
        met = held(alone, theirs, [*keys, "other"])
        way = lambda x, y: F.struct(F.col(x).alias(identity), F.col(y).alias("other"))
        met = met.select(*keys, F.explode(F.array(way(identity, "other"), way("other", identity))).alias("__w")).select(*keys, "__w.*")
        rows = apart(rows).unionByName(apart(met.withColumn("__c", F.lit(0).cast(rows.schema["__c"].dataType)).withColumn("__met", F.lit(True))))
    per = rows.groupBy(*keys, identity, "other").agg(F.sum("__c").alias("overlap"), F.max("__met").alias("__met")).where("overlap > 0 or __met").drop("__met")
    order = W.partitionBy(*keys, identity).orderBy(F.desc("overlap"), "other")
    return per.withColumn("rank", F.row_number().over(order)).where(F.col("rank") < most)


#: Spans whose windows' groups one task sums, on average.
SPANS_OF_TASK = 25_000


def window_groups(spans: DataFrame, keys: Sequence[str], identity: str, most: int = 3) -> DataFrame:
    """``group`` of each identity in each window (``keys``, the window's number among them): itself first, then
    the others in the window that overlap it most, ties by identity, at most ``most`` in all.

    ``spans`` are clipped to the windows, as ``intervals.within`` makes them.
    """
    if most < 1:
        raise ValueError(f"a group holds one at least, got {most}")
    k = list(keys)
    # Bounds and spans are some twelve rows for each span, and much smaller written than in memory.
    parts = max(int(spans.sparkSession.conf.get("spark.sql.shuffle.partitions")), spans.count() // SPANS_OF_TASK + 1)
    spans = spans.repartition(parts, *k)
    there = spans.where("end > start").select(*k, identity).distinct()
    others = there.select(*k, F.col(identity).alias("__other"))
    mine = merge(spans.where("end > start").select(*k, identity, "start", "end"), [*k, identity])
    pairs = mine.join(others, k).where(F.col(identity) != F.col("__other"))
    theirs = mine.select(*k, F.col(identity).alias("__other"), "start", "end")
    shared = covered_within(pairs, theirs, [*k, "__other"], "__c", parts).groupBy(*k, identity, "__other").agg(F.sum("__c").alias("__c"))
    ranked = shared.groupBy(*k, identity).agg(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("__c")).alias("less"), "__other"))), lambda x: x["__other"]).alias("__o"))
    rest = F.slice("__o", 1, most - 1)
    both = there.join(ranked, [*k, identity], "left")
    return both.select(*k, identity, F.when(F.col("__o").isNull() | (F.lit(most) == 1), F.array(identity)).otherwise(F.concat(F.array(identity), rest)).alias("group"))


def votes(rows: DataFrame, keys: Sequence[str] = KEYS, least_seconds=3.0, least_probability=0.5) -> DataFrame:
    """Language votes of detected segments: seconds, segments and weighted probability, ranked.

    ``rows`` has language, detected, duration, probability.
    """
    good = rows.where("detected and language is not null and language not in ('', 'unknown')").where((F.col("duration") >= least_seconds) & (F.col("probability") >= least_probability))
    per = good.groupBy(*keys, "language").agg(F.sum("duration").alias("seconds"), F.count("*").alias("segments"), F.sum(F.col("duration") * F.col("probability")).alias("__w"))
    per = per.withColumn("probability", F.when(F.col("seconds") > 0, F.col("__w") / F.col("seconds")).otherwise(0.0)).drop("__w")
    return per.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("seconds"), F.desc("segments"), "language")))


def decide_language(ranked: DataFrame, videos: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Each video's language: the first vote, or ``unknown``."""
    won = ranked.where("rank = 1").select(*keys, F.col("language").alias("code"), F.col("probability").alias("confidence"))
    found = videos.select(*keys).distinct().join(won, list(keys), "left")
    return found.select(*keys, F.coalesce("code", F.lit("unknown")).alias("code"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), F.when(F.col("code").isNull(), "none").otherwise("segments").alias("source"))


def minority_seconds(rows: DataFrame, decided: DataFrame, keys: Sequence[str] = KEYS, least_seconds=3.0) -> DataFrame:
    """Seconds detected in another language than the video's, for each language."""
    found = rows.where("detected and language is not null and language not in ('', 'unknown')").where(F.col("duration") >= least_seconds).join(decided.select(*keys, "code"), list(keys))
    return found.where("language <> code").groupBy(*keys, "language").agg(F.sum("duration").alias("seconds"))


def take_until(segs: DataFrame, keys: Sequence[str] = KEYS, seconds=30.0, gap=0.25) -> DataFrame:
    """Longest segments first, until they hold ``seconds`` with a gap after each."""
    order = W.partitionBy(*keys).orderBy(F.desc("duration"), "start")
    before = F.coalesce(F.sum(F.col("duration") + gap).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    return segs.withColumn("before", before).where(F.col("before") < seconds)


def speaking(assignments: DataFrame, turns: DataFrame, keys: Sequence[str] = KEYS, gap=0.5) -> DataFrame:
    """When the person behind each face was talking: the turns of its speakers, merged over ``gap``.

    ``assignments``: speaker, face; voices off screen are nobody's.
    """
    on = assignments.where("face <> 'F000'").select(*keys, "speaker", "face").distinct()
    return merge(turns.join(on, [*keys, "speaker"]).select(*keys, "face", "start", "end"), [*keys, "face"], gap)


def voiced_seconds(turns: DataFrame, videos: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """``voiced`` of each video: how long anyone speaks; null where there are no turns at all."""
    length = union_length(turns, keys).withColumnRenamed("length", "voiced")
    return videos.select(*keys).join(length, list(keys), "left")


def language_of(rows: DataFrame, sample: DataFrame, keys: Sequence[str] = KEYS, least_seconds=3.0) -> DataFrame:
    """Each video's language in two passes: the vote of its long segments, else what was detected in a
    sample of its longest ones (``code, confidence``), else ``unknown``.
    """
    k = list(keys)
    voted = votes(rows, keys, least_seconds).where("rank = 1").select(*k, F.col("language").alias("__v"), F.col("probability").alias("__p"))
    heard = sample.select(*k, F.when(~F.col("code").isin("", "unknown"), F.col("code")).alias("__c"), F.col("confidence").alias("__q"))
    both = rows.select(*k).distinct().join(voted, k, "left").join(heard, k, "left")
    return both.select(
        *k,
        F.coalesce("__v", "__c", F.lit("unknown")).alias("code"),
        F.when(F.col("__v").isNotNull(), F.col("__p")).when(F.col("__c").isNotNull(), F.col("__q")).otherwise(F.lit(0.0)).alias("confidence"),
        F.when(F.col("__v").isNotNull(), "segments").when(F.col("__c").isNotNull(), "sample").otherwise("none").alias("source"),
    )


def forced_language(segs: DataFrame, decided: DataFrame, keys: Sequence[str] = KEYS, least_seconds=3.0) -> DataFrame:
    """Segments with the ``language`` they are transcribed in: short ones in the video's, unless that is
    unknown; for long ones it is detected (null).
    """
    both = segs.join(decided.select(*keys, "code"), list(keys), "left")
    forced = (F.col("duration") < least_seconds) & (F.col("code") != "unknown")
    return both.withColumn("language", F.when(forced, F.col("code"))).drop("code")


def context_window(start, end, fps, frames, context=0.0) -> tuple[Column, Column]:
    """First and end frame of a segment with context around it, within the video's frames, one at least."""
    first = F.greatest(F.lit(0), F.bround((start - context) * fps).cast("int"))
    last = F.least(F.greatest(F.lit(1), frames), F.bround((end + context) * fps).cast("int"))
    return first, F.greatest(first + 1, last)


def trim_offset(start, first_frame, fps) -> Column:
    """Seconds to cut from the beginning of audio that was extracted from a frame on."""
    return start - first_frame / fps
