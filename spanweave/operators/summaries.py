"""Summaries of detections, tracks and composed annotations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import KEYS


def upper_median(values: Column) -> Column:
    """The middle of sorted values, of two the greater."""
    s = F.array_sort(F.array_compact(values))
    return F.when(F.size(s) > 0, F.get(s, F.floor(F.size(s) / 2).cast("int")))


def detection_tally(frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sampled frames, those with faces, a histogram of faces a frame, and scores' spread.

    ``frames``: a row for each sampled frame with ``scores``, an array.
    """
    n = F.size("scores")
    per = frames.groupBy(*keys, n.alias("faces")).agg(F.count("*").alias("n"))
    shape = per.groupBy(*keys).agg(
        F.sum("n").alias("sampled"), F.sum(F.when(F.col("faces") > 0, F.col("n")).otherwise(0)).alias("with_faces"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("faces", "n")))).alias("histogram")
    )
    each = frames.select(*keys, F.explode("scores").alias("score"))
    spread = each.groupBy(*keys).agg(F.min("score").alias("least"), F.median("score").alias("median"), F.max("score").alias("most"), F.count_if(F.col("score") < 0.7).alias("below_70"), F.count_if(F.col("score") < 0.5).alias("below_50"))
    return shape.join(spread, list(keys), "left")


def track_summary(quality: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Tracks' lengths and how broken up they are."""
    found = quality.groupBy(*keys).agg(
        F.count("*").alias("tracks"), F.min("frames").alias("least"), F.max("frames").alias("most"), F.collect_list("frames").alias("__f"), F.count_if(F.col("frames") == 1).alias("single"), F.count_if(F.col("frames") <= 3).alias("up_to_three"), F.count_if(F.col("motion") < 0.005).alias("near_static")
    )
    return found.withColumn("median", upper_median(F.col("__f"))).withColumn("broken_share", F.col("up_to_three") / F.col("tracks")).drop("__f")


def best_sighting(detections: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key's detection of the highest score, then the largest area, then the earliest."""
    best = F.max_by(F.struct("frame", "x", "y", "w", "h", "score"), F.struct("score", F.col("w") * F.col("h"), -F.col("frame")))
    return detections.groupBy(*keys).agg(best.alias("best")).select(*keys, "best.*")


def notes(assignments: DataFrame, utterances: DataFrame, tracks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Voices off screen, faces that say nothing, and merged voices, for each video."""
    k = list(keys)
    off = assignments.groupBy(*k).agg(F.array_sort(F.collect_set(F.when(F.col("face") == "F000", F.col("speaker")))).alias("offscreen"), F.count_if("merged").alias("merged"))
    silent = tracks.join(utterances.select(*k, "face"), [*k, "face"], "left_anti").groupBy(*k).agg(F.array_sort(F.collect_set("face")).alias("silent"))
    return off.join(silent, k, "full")
