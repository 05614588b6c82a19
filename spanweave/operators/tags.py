"""Paralinguistic labels reduced to one tag for each utterance."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import slug

#: Label slugs of each model and the tags they mean.
EMOTION = {
    "angry": "angry", "生气-angry": "angry", "disgusted": "disgusted", "厌恶-disgusted": "disgusted", "fearful": "fearful", "恐惧-fearful": "fearful",
    "happy": "happy", "开心-happy": "happy", "sad": "sad", "难过-sad": "sad", "surprised": "surprised", "吃惊-surprised": "surprised",
    "neutral": "neutral", "中立-neutral": "neutral", "other": "other", "其他-other": "other", "unknown": "unknown", "unk": "unknown",
}
DELIVERY = {
    "whispering": "whispering", "whispered": "whispering", "whispery-voice": "whispering", "whisper-talk-style": "whispering", "asmr-whisper-delivery": "whispering",
    "shouting": "shouting", "angry-shouting": "shouting", "screaming": "shouting", "breathy": "breathy", "slightly-breathy": "breathy", "breathy-voice": "breathy",
    "laughing-while-speaking": "laughing", "giggling-delivery": "laughing", "sing-speaking": "singing", "crying": "crying",
}
EVENT = {
    "laughter": "laughter", "chuckle-chortle": "laughter", "giggle": "laughter", "snicker": "laughter", "belly-laugh": "laughter", "crying-sobbing": "crying",
    "sob": "crying", "whimper": "crying", "screaming": "screaming", "singing": "singing", "sigh": "sigh", "cough": "cough", "throat-clearing": "throat-clearing",
    "sneeze": "sneeze", "sniff": "sniff", "sniffing": "sniff", "breathing": "breathing", "wheeze": "breathing", "gasp": "breathing", "pant": "breathing",
}
SILENT = ("neutral", "other", "unknown", "none", "unintelligible")
#: Label slugs that the models give and that no tag is wanted for.
IGNORED = {
    "emotion": (),
    "delivery": (
        "quiet", "very-quiet", "loud", "very-loud", "normal-loudness", "slightly-dynamic", "dynamic", "monotone", "natural-speaking", "casual-speaking-style",
        "formal-style", "narration-style-delivery", "newsreader-style", "storytelling-style", "monologue-style", "authoritative-style", "high-energy-delivery",
        "slow-deliberate-delivery", "precise-articulation", "neutral-articulation", "slightly-imprecise-articulation", "naturalness", "natural-genuine",
        "slightly-unnatural", "fluent", "halting-speech", "disfluent", "neutral-airflow", "modal-voice", "pressed-voice", "slack-voice", "rough-voice", "tense-voice",
        "slightly-tense-voice", "strained-voice", "strained-delivery", "fatigued-delivery", "out-of-breath-delivery", "gasping-delivery", "pleading-tone",
        "sad-speaking", "falling-intonation", "irregular-intonation", "ranting-style", "ranting-style-delivery", "sighing-delivery", "suitable-for-work",
        "not-suitable-for-work",
    ),
    "event": (
        "speech", "conversation", "narration-monologue", "speech-synthesizer", "whispering", "shout", "yell", "babbling", "murmur", "silence", "inside-small-room",
        "inside-large-room", "outside-urban-or-man-made", "outside-rural-or-natural", "field-recording", "music", "background-noise", "white-noise", "pink-noise",
        "noise", "environmental-noise",
    ),
}
#: Dimensions, the first taking precedence.
PRECEDENCE = ("event", "delivery", "emotion")


def vocabulary(spark: SparkSession) -> DataFrame:
    """``dimension, label, tag``: the fixed tables."""
    rows = [(d, k, v) for d, labels in zip(PRECEDENCE, (EVENT, DELIVERY, EMOTION), strict=True) for k, v in labels.items()]
    return spark.createDataFrame(rows, "dimension string, label string, tag string")


def ignored(label: Column, dimension: Column) -> Column:
    """Whether a label is one that its model is known to give and that no tag is wanted for."""
    known = reduce(lambda c, d: c.when(dimension == d, slug(label).isin(*IGNORED[d])) if IGNORED[d] else c, PRECEDENCE, F.when(F.lit(False), F.lit(False)))
    return F.coalesce(known, F.lit(False))


def floors(least, dimension: Column) -> Column:
    """The score from which a dimension's labels count: one number, or one for each dimension (else 0.5)."""
    if not isinstance(least, dict):
        return F.lit(float(least))
    return F.coalesce(*[F.when(dimension == d, F.lit(float(x))) for d, x in least.items()], F.lit(0.5))


def mapped(scores: DataFrame, words: DataFrame) -> DataFrame:
    """Scores (``dimension, label, score``) with their ``tag``; labels without one, and silent ones, go.

    The vocabulary is a fixed table of a few dozen rows.
    """
    return scores.withColumn("label", slug(F.col("label"))).join(words, ["dimension", "label"]).where(~F.col("tag").isin(*SILENT))


def unmapped(scores: DataFrame, words: DataFrame, least=0.5) -> DataFrame:
    """Confident labels that the vocabulary lacks, with how often they came.

    Silent labels and those that are known to be of no use are no news and left out.
    """
    said = scores.where(F.col("score") >= floors(least, F.col("dimension"))).withColumn("label", slug(F.col("label")))
    said = said.where(~F.col("label").isin(*SILENT) & ~ignored(F.col("label"), F.col("dimension")))
    return said.join(words, ["dimension", "label"], "left_anti").groupBy("dimension", "label").agg(F.count("*").alias("n"))


def top_labels(scores: DataFrame, keys: Sequence[str], most: int) -> DataFrame:
    """The ``most`` highest-scoring labels of each key and dimension, ties by ``position``, the model's order."""
    order = W.partitionBy(*keys, "dimension").orderBy(F.desc("score"), "position")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def reduce_tags(scores: DataFrame, words: DataFrame, keys: list[str], least=0.5, close=0.1, order=PRECEDENCE, every: DataFrame | None = None) -> DataFrame:
    """One tag for each key: the best of the first dimension that has any.

    ``least``: the score from which labels count, for all dimensions or for each.  ``margin`` is the
    score less the best other candidate's (itself if there is none), and may be negative;
    ``candidates`` counts the dimensions that had one; ``reason`` says what it was chosen over.
    With ``every`` (the keys) those without a candidate get a row without a tag.
    """
    good = mapped(scores, words).where(F.col("score") >= floors(least, F.col("dimension")))
    first = W.partitionBy(*keys, "dimension").orderBy(F.desc("score"), "tag", "label")
    best = good.withColumn("__n", F.row_number().over(first)).where("__n = 1")
    rank = F.array_position(F.array(*[F.lit(d) for d in order]), F.col("dimension"))
    by_rank = W.partitionBy(*keys).orderBy(rank)
    found = best.withColumn("__r", F.row_number().over(by_rank))
    found = found.groupBy(*keys).agg(
        F.min_by("dimension", "__r").alias("dimension"),
        F.min_by("tag", "__r").alias("tag"),
        F.min_by("label", "__r").alias("label"),
        F.min_by("score", "__r").alias("score"),
        F.count("*").alias("candidates"),
        # Of rivals that score alike the one of the earlier dimension.
        F.max(F.when(F.col("__r") > 1, F.struct("score", (-F.col("__r")).alias("r"), "dimension"))).alias("__o"),
    )
    margin = F.when(F.col("__o").isNull(), F.col("score")).otherwise(F.col("score") - F.col("__o.score"))
    takes = F.concat("dimension", F.lit(" takes precedence"))
    # The texts of the reasons.
    text = F.when(F.col("__o").isNull() | (margin >= close), takes).when(margin < 0, F.concat(takes, F.lit(" over a higher-scoring "), F.col("__o.dimension"))).otherwise(F.concat(takes, F.lit(" over a close "), F.col("__o.dimension")))
    chosen = found.select(*keys, "tag", "dimension", "label", "score", margin.alias("margin"), "candidates", text.alias("reason"))
    if every is None:
        return chosen
    none = F.coalesce("reason", F.lit("no dimension scored a known label above its threshold"))
    return every.select(*keys).join(chosen, keys, "left").withColumn("reason", none).na.fill(0, ["candidates"])


def tag_counts(choices: DataFrame, eligible: DataFrame, keys: Sequence[str], close=0.1) -> DataFrame:
    """How the tagging of each key went: segments, eligible, tagged, untagged, too short, close calls.

    ``eligible`` has a row for each segment, with ``eligible``; ``choices`` are ``reduce_tags`` of the
    eligible ones.
    """
    k = list(keys)
    segs = eligible.groupBy(*k).agg(F.count("*").alias("segments"), F.count_if("eligible").alias("eligible"))
    got = choices.groupBy(*k).agg(F.count_if(F.col("tag").isNotNull()).alias("tagged"), F.count_if((F.col("candidates") > 1) & (F.col("margin") < close)).alias("close_calls"))
    both = segs.join(got, k, "left").na.fill(0, ["tagged", "close_calls"])
    return both.select(*k, "segments", "eligible", "tagged", (F.col("eligible") - F.col("tagged")).alias("untagged"), (F.col("segments") - F.col("eligible")).alias("too_short"), "close_calls")
