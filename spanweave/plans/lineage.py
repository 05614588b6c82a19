"""Incremental runs: input hashes, what must run again and why, and the report over a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.intervals import apart

#: Stages in their order.
STAGES = ("s0-preprocess", "s1-faces", "s2-tracks", "s3-cluster", "s4-diarize", "s5-asd", "s6-associate", "s7-tse", "s8-asr", "s9-paralinguistic", "s10-caption", "s11-compose")


def payload_hash(**parts: Column) -> Column:
    """SHA-256 of a row's values as JSON with sorted keys; null values are left out."""
    return F.sha2(F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)])), 256)


def latest(state: DataFrame, keys: Sequence[str] = ("video_id", "stage")) -> DataFrame:
    """The last record of each stage of each video."""
    order = W.partitionBy(*keys).orderBy(F.desc("finished_at"))
    return state.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def reasons_to_run(planned: DataFrame, state: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Planned stages (``video_id, stage, code_version, input_hash``) with the ``reason`` to run, null for none.

    ``state`` has status, code_version, input_hash and artifacts (path, sha256, size); ``files`` has
    path, sha256 and size of what is there.
    """
    last = latest(state)
    last = last.select("video_id", "stage", "status", F.col("code_version").alias("__code"), F.col("input_hash").alias("__input"), *(["artifacts"] if files is not None else []))
    both = planned.join(last, ["video_id", "stage"], "left")
    lost = F.lit(None).cast("string")
    if files is not None:
        each = last.select("video_id", "stage", F.posexplode("artifacts").alias("__i", "a")).join(
            files.select(F.col("path").alias("__p"), F.col("sha256").alias("__sha"), F.col("size").alias("__size")), F.col("a.path") == F.col("__p"), "left"
        )
        what = F.when(F.col("__p").isNull(), F.concat(F.lit("missing artifact "), "a.path")).when(F.col("a.size") != F.col("__size"), F.concat(F.lit("artifact "), "a.path", F.lit(" changed size"))).when(F.col("a.sha256") != F.col("__sha"), F.concat(F.lit("artifact "), "a.path", F.lit(" changed content")))
        bad = each.withColumn("__w", what).where("__w is not null").groupBy("video_id", "stage").agg(F.min_by("__w", "__i").alias("__lost"))
        both, lost = both.join(bad, ["video_id", "stage"], "left"), F.col("__lost")
    # The texts of the reasons.
    reason = (
        F.when(F.col("status").isNull(), "no previous run")
        .when(F.col("status") != "ok", F.concat(F.lit("previous run "), "status"))
        .when(F.col("code_version") != F.col("__code"), F.concat(F.lit("code changed ("), "__code", F.lit(" -> "), "code_version", F.lit(")")))
        .when(F.col("input_hash") != F.col("__input"), "inputs changed")
        .otherwise(lost)
    )
    return both.select("video_id", "stage", reason.alias("reason"))


def first_failures(state: DataFrame, order: Sequence[str] = STAGES) -> DataFrame:
    """The first failed stage of each video in pipeline order, with its error."""
    place = F.array_position(F.array(*[F.lit(s) for s in order]), F.col("stage"))
    return state.where("status = 'failed'").groupBy("video_id").agg(F.min_by("stage", place).alias("failed_stage"), F.min_by("error", place).alias("error"))


def outcomes(expected: DataFrame, state: DataFrame, delivered: DataFrame, order: Sequence[str] = STAGES) -> DataFrame:
    """How each expected or seen video ended.

    A delivered video is ok whatever its records say; else it stopped at its first failed stage;
    else nothing was recorded, or no stage ever ran.
    """
    known = apart(expected.select("video_id")).union(apart(state.select("video_id"))).union(apart(delivered.select("video_id"))).distinct()
    ran = state.groupBy("video_id").agg(F.count("*").alias("stages_ran"))
    found = known.join(delivered.select("video_id").distinct().withColumn("__ok", F.lit(True)), "video_id", "left").join(first_failures(state, order), "video_id", "left").join(ran, "video_id", "left")
    ok = F.coalesce("__ok", F.lit(False))
    error = F.when(ok, "").when(F.col("failed_stage").isNotNull(), F.coalesce("error", F.lit(""))).when(F.col("stages_ran") > 0, "no stage recorded anything for this video").otherwise("no stage ever ran for this video")
    return found.select("video_id", ok.alias("ok"), F.when(~ok, F.col("failed_stage")).alias("failed_stage"), error.alias("error"), F.coalesce("stages_ran", F.lit(0)).alias("stages_ran"))


def stopped_at(outcome: DataFrame) -> DataFrame:
    """How many videos stopped at each stage."""
    return outcome.where("not ok").groupBy(F.coalesce("failed_stage", F.lit("never started")).alias("stage")).agg(F.count("*").alias("videos"))


def common_errors(outcome: DataFrame, most: int = 10) -> DataFrame:
    """The most common errors by stage: a report's top rows."""
    return outcome.where("not ok").groupBy("failed_stage", "error").agg(F.count("*").alias("videos")).orderBy(F.desc("videos"), "failed_stage", "error").limit(most)


def stage_seconds(log: DataFrame) -> DataFrame:
    """Seconds and runs of each stage from ``stages`` (map of stage to seconds); stages of no time are left out."""
    each = log.select("video_id", F.explode("stages").alias("stage", "seconds"))
    return each.groupBy("stage").agg(F.round(F.sum("seconds"), 2).alias("seconds"), F.count("*").alias("runs")).where("seconds > 0")
