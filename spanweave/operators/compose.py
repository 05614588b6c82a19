"""What composing an annotation joins: captions, people, their tracks, vectors and speech."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import KEYS, merge, presence, union_length


def weighted_mean(value: Column, weight: Column) -> Column:
    """Mean of a group's values by weight; the plain mean where nothing weighs, 0 where there is nothing."""
    total = F.sum(F.when(value.isNotNull(), weight))
    return F.coalesce(F.when(total > 0, F.sum(value * weight) / total).otherwise(F.avg(value)), F.lit(0.0))


def ordered_mean(rows: str, value: str, weight: str) -> Column:
    """``weighted_mean`` of a list of rows, added up one after the other, so that the last digit does not depend on
    how rows were dealt."""
    known = F.filter(rows, lambda r: r[value].isNotNull() & r[weight].isNotNull())
    add = lambda f: F.aggregate(known, F.lit(0.0), lambda s, r: s + f(r))
    total = add(lambda r: r[weight])
    have = F.filter(rows, lambda r: r[value].isNotNull())
    plain = F.when(F.size(have) > 0, F.aggregate(have, F.lit(0.0), lambda s, r: s + r[value]) / F.size(have))
    return F.coalesce(F.when(total > 0, add(lambda r: r[value] * r[weight]) / total).otherwise(plain), F.lit(0.0))


def shots_with_captions(shots: DataFrame, captions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Every shot with its ``caption`` by index; without one the empty text."""
    said = captions.select(*keys, "index", F.col("caption").alias("__c"))
    return shots.drop("caption").join(said, [*keys, "index"], "left").withColumn("caption", F.coalesce("__c", F.lit(""))).drop("__c")


def members(identities: DataFrame, tracklets: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The tracklets of each person (``face``), with their ``position`` in its list; unknown ids are passed over."""
    each = identities.select(*keys, "face", F.posexplode("track_ids").alias("position", "track_id"))
    return each.join(tracklets, [*keys, "track_id"])


def visible_spans(sightings: DataFrame, keys: Sequence[str] = KEYS, gap=0.5, single=0.1) -> DataFrame:
    """When each face is in view: the presence of its tracklets (``face, track_id, t``), merged over ``gap``."""
    k = list(keys)
    return merge(presence(sightings, [*k, "face", "track_id"], single).select(*k, "face", "start", "end"), [*k, "face"], gap)


def face_tracks(member: DataFrame, speech: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row for each person that was seen, whether it ever spoke or not.

    ``member``: face, position, track_id, first_time, last_time, detections, frames, mean_score,
    motion; ``speech``: face, start, end.  Means are by frames, so a sliver counts for little.
    """
    k = list(keys)
    seen = member.where("detections > 0").select(*k, "face").distinct()
    per = member.join(seen, [*k, "face"], "left_semi").groupBy(*k, "face").agg(
        F.min("first_time").alias("first_seen"),
        F.max("last_time").alias("last_seen"),
        F.transform(F.array_sort(F.collect_list(F.struct("position", "track_id"))), lambda m: m["track_id"].cast("string")).alias("tracklets"),
        F.count("*").cast("double").alias("n_tracklets"),
        F.sum("detections").cast("double").alias("n_detections"),
        weighted_mean(F.col("mean_score"), F.col("frames")).alias("mean_score"),
        weighted_mean(F.col("motion"), F.col("frames")).alias("motion"),
    )
    spoken = union_length(speech, [*k, "face"]).withColumnRenamed("length", "total_speech")
    both = per.join(spoken, [*k, "face"], "left").withColumn("total_speech", F.coalesce("total_speech", F.lit(0.0)))
    quality = F.create_map(F.lit("tracklets"), F.col("n_tracklets"), F.lit("detections"), F.col("n_detections"), F.lit("mean_score"), F.col("mean_score"), F.lit("motion"), F.col("motion"))
    return both.select(*k, "face", "first_seen", "last_seen", (F.col("total_speech") > 0).alias("speaks"), "total_speech", "tracklets", quality.alias("quality"))


def track_vectors(detections: DataFrame, embeddings: DataFrame, keys: Sequence[str] = KEYS, item: str = "track_id") -> DataFrame:
    """``centroid`` (of unit length), ``cohesion`` (mean cosine of its pairs, 1 of one alone) and ``samples``
    of each tracklet's vectors.

    ``detections``: item, emb (a row of ``embeddings``: emb, vec); those without one do not count.
    Vectors are summed by coordinate before the shuffle: no pairs are made.
    """
    k = [*keys, item]
    found = detections.where("emb is not null").select(*k, "emb").join(embeddings.select(*keys, "emb", "vec"), [*keys, "emb"])
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    parts = found.select(*k, norm.alias("__n"), F.posexplode("vec").alias("i", "x")).select(*k, "i", F.when(F.col("__n") > 0, F.col("x").cast("double") / F.col("__n")).otherwise(0.0).alias("x"))
    sums = parts.groupBy(*k, "i").agg(F.sum("x").alias("s"), F.sum(F.col("x") * F.col("x")).alias("q"), F.count("*").alias("n"))
    per = sums.groupBy(*k).agg(F.max("n").alias("samples"), F.sum(F.col("s") * F.col("s")).alias("__ss"), F.sum("q").alias("__q"), F.array_sort(F.collect_list(F.struct("i", "s"))).alias("__v"))
    cohesion = F.when(F.col("samples") > 1, (F.col("__ss") - F.col("__q")) / (F.col("samples") * (F.col("samples") - 1))).otherwise(1.0)
    centroid = F.transform("__v", lambda p: F.when(F.col("__ss") > 0, p["s"] / F.sqrt("__ss")).otherwise(0.0))
    return per.select(*k, centroid.alias("centroid"), cohesion.alias("cohesion"), "samples")


def identity_rollup(member: DataFrame, vectors: DataFrame, keys: Sequence[str] = KEYS, static=0.005, rounded: bool = True) -> DataFrame:
    """Each person's numbers over its tracklets, and whether it may be a picture rather than a person.

    ``member`` as in ``face_tracks``, with ``span`` and ``mean_height``; ``vectors`` of ``track_vectors``.
    Numbers are rounded as they are written down, unless asked for as they are.
    """
    near = lambda c, places: F.round(c, places) if rounded else c
    k = [*keys, "face"]
    both = member.join(vectors.select(*keys, "track_id", "cohesion"), [*keys, "track_id"], "left")
    cols = ("position", "track_id", "mean_score", "mean_height", "motion", "cohesion", "frames")
    per = both.groupBy(*k).agg(
        F.array_sort(F.collect_list(F.struct(*cols))).alias("__rows"),
        near(F.min("first_time"), 4).alias("first_seen"), near(F.max("last_time"), 4).alias("last_seen"), near(F.sum("span"), 4).alias("screen_time"), F.sum("frames").alias("frames"), F.count("*").alias("tracks"),
    )
    mean = lambda c: ordered_mean("__rows", c, "frames")
    seen = F.filter("__rows", lambda r: r["cohesion"].isNotNull())
    cohesion = F.when(F.size(seen) > 0, F.aggregate(seen, F.lit(0.0), lambda s, r: s + r["cohesion"]) / F.size(seen))
    return per.select(
        *k, F.transform("__rows", lambda m: m["track_id"]).alias("track_ids"), "first_seen", "last_seen", "screen_time", "frames", "tracks",
        near(mean("mean_score"), 4).alias("mean_score"), near(mean("mean_height"), 2).alias("mean_height"), near(mean("motion"), 5).alias("motion"), near(cohesion, 4).alias("cohesion"), (mean("motion") < static).alias("suspect_static"),
    )


def shot_identities(shots: DataFrame, keys: Sequence[str] = KEYS, column: str = "roster") -> DataFrame:
    """All identities named over the shots of a video, sorted."""
    each = shots.select(*keys, F.explode_outer(column).alias("face"))
    return each.groupBy(*keys).agg(F.array_sort(F.collect_set("face")).alias("identities"))


def mean_probability(samples: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean of each trace's probabilities (``p``); null of one without samples."""
    return samples.groupBy(*keys).agg(F.avg("p").alias("probability"))


def trace_peaks(samples: DataFrame, keys: Sequence[str] = KEYS, least=0.5) -> DataFrame:
    """Of each trace its samples, ``peak``, when that is first reached, mean, and whether it ``speaks``."""
    per = samples.groupBy(*keys).agg(F.count("p").alias("samples"), F.max("p").alias("peak"), F.max_by("t", F.struct("p", -F.col("t"))).alias("peak_at"), F.avg("p").alias("mean"))
    return per.withColumn("speaks", F.col("peak") >= least)


def spoken_seconds(segments: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Sum of the segments' lengths, overlaps counted each."""
    return segments.groupBy(*keys).agg(F.sum(F.col("end") - F.col("start")).alias("seconds"))


def notes(assignments: DataFrame, segments: DataFrame, tracks: DataFrame, captions: DataFrame, videos: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """What a report says of how its numbers came about, for each video.

    Voices off screen, extractions without sound, faces that say nothing, and of the global caption
    (``dropped, flags, frames``) the names dropped, its flags and frames.
    """
    k = list(keys)
    parts = (
        assignments.groupBy(*k).agg(F.count_if(F.col("face") == "F000").alias("offscreen_speakers")),
        segments.groupBy(*k).agg(F.count_if(F.coalesce("silent", F.lit(False))).alias("silent_extractions")),
        tracks.groupBy(*k).agg(F.count_if(~F.col("speaks")).alias("unclaimed_faces")),
        captions.select(*k, F.col("dropped").alias("caption_names_dropped"), F.col("flags").alias("caption_flags"), F.col("frames").alias("caption_frames")),
    )
    found = videos.select(*k)
    for part in parts:
        found = found.join(part, k, "left")
    return found.na.fill(0, ["offscreen_speakers", "silent_extractions", "unclaimed_faces", "caption_frames"])


def extraction_summary(planned: DataFrame, segments: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Planned, written, skipped and silent extractions of each video, their seconds and whose they are."""
    k = list(keys)
    want = planned.groupBy(*k).agg(F.count("*").alias("planned"))
    got = segments.groupBy(*k).agg(F.count("*").alias("written"), F.count_if(F.coalesce("silent", F.lit(False))).alias("silent"), F.round(F.sum(F.col("end") - F.col("start")), 3).alias("seconds"), F.array_sort(F.collect_set("identity")).alias("identities"))
    both = want.join(got, k, "left").na.fill(0, ["written", "silent", "seconds"])
    return both.select(*k, "planned", "written", (F.col("planned") - F.col("written")).alias("skipped"), "silent", "seconds", F.coalesce("identities", F.array().cast("array<string>")).alias("identities"))


def transcript_summary(sources: DataFrame, transcripts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Segments, transcripts, empty and flagged ones, seconds, and where the audio came from.

    ``sources``: name, identity, start, end, source; ``transcripts``: name, words (count), flags.
    """
    k = list(keys)
    have = sources.groupBy(*k).agg(
        F.count("*").alias("segments"), F.round(F.sum(F.col("end") - F.col("start")), 3).alias("seconds"), F.count_if(F.col("source") == "mix").alias("from_mix"), F.count_if(F.col("source") != "mix").alias("from_extracted"), F.array_sort(F.collect_set("identity")).alias("identities")
    )
    said = transcripts.groupBy(*k).agg(F.count("*").alias("transcribed"), F.count_if(F.col("words") == 0).alias("empty"), F.count_if(F.size("flags") > 0).alias("flagged"))
    return have.join(said, k, "left").na.fill(0, ["transcribed", "empty", "flagged"])


def caption_summary(captions: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Shots, captioned and empty ones, and those that name anyone (``caption, referenced, dropped``)."""
    text = F.coalesce("caption", F.lit("")) != ""
    return captions.groupBy(*keys).agg(F.count("*").alias("shots"), F.count_if(text).alias("captioned"), F.count_if(~text).alias("empty"), F.count_if(F.size("referenced") > 0).alias("named"), F.sum(F.size("dropped")).alias("dropped_names"))


def cluster_summary(tracklets: DataFrame, identities: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Tracklets, people, and how tracklets were kept or dropped (``reason`` null: kept)."""
    k = list(keys)
    each = tracklets.groupBy(*k).agg(F.count("*").alias("tracklets"), F.count_if(F.col("reason").isNull()).alias("clustered"), F.count("reason").alias("dropped"))
    people = identities.groupBy(*k).agg(F.count("*").alias("identities"), F.min(F.size("track_ids")).alias("fewest"), F.max(F.size("track_ids")).alias("most"), F.count_if("suspect_static").alias("suspect_static"))
    return each.join(people, k, "left").na.fill(0, ["identities", "fewest", "most", "suspect_static"])


def silent_extraction(samples: Column, least=1e-4) -> tuple[Column, Column]:
    """Root mean square of samples, and whether that is too little to be heard; of none 0."""
    power = F.aggregate(samples, F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    rms = F.when(F.size(samples) > 0, F.sqrt(power / F.size(samples))).otherwise(0.0)
    return rms, rms < least


def longest_first(segments: DataFrame, keys: Sequence[str] = KEYS) -> Column:
    """The rank of a segment by length, the longest first, the earlier of two alike."""
    return F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("duration"), "start"))
