"""Transcripts: flags, word timing, and their projection to utterances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import squeezed, tag
from .intervals import KEYS


def flags(text, no_speech, logprob, compression, most_no_speech=0.6, least_logprob=-1.0, most_compression=2.4) -> Column:
    """What makes a transcript doubtful, in a fixed order; a missing measure flags nothing."""
    return F.array_compact(
        F.array(
            F.when(F.coalesce(F.trim(text), F.lit("")) == "", "empty"),
            F.when(no_speech > most_no_speech, "no_speech"),
            F.when(logprob < least_logprob, "low_confidence"),
            F.when(compression > most_compression, "repetition"),
        )
    )


def offset_words(words: Column, origin) -> Column:
    """Words (``text, start, end, probability``) moved by the time their audio began."""
    return F.transform(words, lambda w: w.withField("start", w["start"] + origin).withField("end", w["end"] + origin))


def clip_words(words: Column, start, end, least=0.5) -> Column:
    """Words with at least ``least`` of their length in the span; those without length, that begin in it."""

    def kept(w: Column) -> Column:
        shared = F.greatest(F.lit(0.0), F.least(w["end"], end) - F.greatest(w["start"], start))
        length = w["end"] - w["start"]
        return F.when(length > 0, shared >= least * length).otherwise((w["start"] >= start) & (w["start"] <= end))

    return F.filter(words, kept)


def words_text(words: Column) -> Column:
    """The words as spoken, white space collapsed."""
    return squeezed(F.array_join(F.transform(words, lambda w: w["text"]), ""))


def utterances(segments: DataFrame, transcripts: DataFrame, tags: DataFrame, limit, keys: Sequence[str] = KEYS) -> DataFrame:
    """Segments with a transcript of any text, their tag if they have one, clamped to the video.

    Joined on the segment's name; flags of both sides without repeats; confidence is the language
    probability, else the mean log probability.
    """
    both = segments.join(transcripts, [*keys, "name"]).join(tags.select(*keys, "name", "tag"), [*keys, "name"], "left").where(F.trim("text") != "")
    return both.select(
        *keys,
        "name",
        F.col("identity").alias("face"),
        F.least(F.greatest("start", F.lit(0)), limit).alias("start"),
        F.least(F.greatest("end", F.lit(0)), limit).alias("end"),
        tag(F.col("tag")).alias("tag"),
        F.trim("text").alias("text"),
        F.coalesce("language_probability", "avg_logprob").alias("confidence"),
        F.array_distinct(F.concat(F.coalesce("segment_flags", F.array().cast("array<string>")), F.coalesce("flags", F.array().cast("array<string>")))).alias("flags"),
    )


def flag_counts(rows: DataFrame, keys: Sequence[str] = KEYS, column: str = "flags") -> DataFrame:
    """How often each flag comes, as a map in the order of names."""
    each = rows.select(*keys, F.explode(column).alias("flag")).groupBy(*keys, "flag").agg(F.count("*").alias("n"))
    return each.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("flag", "n")))).alias("counts"))


def merge_adjacent(segments: DataFrame, keys: Sequence[str], max_gap=0.0) -> DataFrame:
    """Segments joined over gaps of at most ``max_gap``, with their flags in order and without repeats."""
    order = W.partitionBy(*keys).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1))
    marked = segments.withColumn("__new", F.when(reach.isNull() | (F.col("start") - reach > max_gap), 1).otherwise(0))
    marked = marked.withColumn("__i", F.sum("__new").over(order.rowsBetween(W.unboundedPreceding, 0)))
    gathered = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("start", "end", "flags"))), lambda x: x["flags"])))
    return marked.groupBy(*keys, "__i").agg(F.min("start").alias("start"), F.max("end").alias("end"), gathered.alias("flags")).drop("__i")
