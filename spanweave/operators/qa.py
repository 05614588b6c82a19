"""Checks of composed annotations: gates that name the first violation, and reported metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import tag, unrenderable
from .intervals import KEYS, depth, union_length
from .script import parse

GATES = ("format_hygiene", "id_integrity", "timeline_sanity", "speech_accounting", "render_round_trip")
#: Characters that a line cannot carry, as the gate names them.
UNSAFE = (("<", "'<'"), (">", "'>'"), ("\n", "'\\n'"), ("\r", "'\\r'"))


def gates(utterances: DataFrame, tracks: DataFrame, videos: DataFrame, keys: Sequence[str] = KEYS, tolerance=1.5, slack=1e-6, scripts: DataFrame | None = None) -> DataFrame:
    """For each video and gate, in the fixed order: ``passed``, how many ``violations``, and a ``detail``
    that names the first one, or what was checked.

    ``utterances`` has ``face, tag, text, start, end``; ``tracks`` has ``face``; ``videos`` has
    ``duration`` and ``voiced`` (null: accounting is not checked).  Without ``scripts`` the round
    trip is left out.  Utterances count in the order of start, end and face.  References are not
    checked in a video without tracks.
    """
    k = list(keys)
    who = W.partitionBy(*k)
    known = tracks.groupBy(*k, "face").agg(F.count("*").alias("__times"))
    per_video = known.groupBy(*k).agg(F.count("*").alias("__faces"), F.min(F.when(F.col("__times") > 1, F.col("face"))).alias("__twice"), F.count_if((F.col("__times") > 1) | (F.col("face") == "F000")).alias("__bad"), F.max(F.col("face") == "F000").alias("__reserved"))
    u = utterances.select(*k, "face", "tag", "text", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))
    u = u.join(videos.select(*k, F.col("duration").cast("double").alias("duration")), k).join(known.select(*k, "face", F.lit(True).alias("__known")), [*k, "face"], "left").join(per_video.select(*k, "__faces"), k, "left")
    u = u.withColumns({"__n": F.row_number().over(who.orderBy("start", "end", "face")) - 1, "__before": F.lag("end").over(W.partitionBy(*k, "face").orderBy("start", "end"))})
    at = F.format_string("%s utterance at %.2fs ", "face", "start")
    hygiene = F.when(F.trim(F.coalesce("text", F.lit(""))) == "", F.concat(at, F.lit("has empty text")))
    for c, name in UNSAFE:
        hygiene = hygiene.when(F.instr("text", c) > 0, F.concat(at, F.lit(f"contains {name}")))
    dangling = F.when((F.col("face") != "F000") & (F.col("__faces") > 0) & F.col("__known").isNull(), F.format_string("utterance references %s, which has no face track", "face"))
    beyond = F.greatest(F.col("end") - F.col("duration"), -F.col("start"))
    span = (
        F.when(F.col("end") < F.col("start"), F.format_string("%s utterance ends before it starts: %s", "face", F.col("start").cast("string")))
        .when((F.col("start") < 0) | (F.col("end") > F.col("duration") + slack), F.format_string("%s utterance [%.3f, %.3f] falls outside the video's %.3fs by %.6fs", "face", "start", "end", "duration", beyond))
    )
    over = F.when(F.col("start") < F.col("__before") - slack, F.format_string("%s has overlapping utterances at %.2fs (previous ended %.2fs)", "face", "start", "__before"))
    u = u.withColumns({"__h": hygiene, "__d": dangling, "__s": span, "__o": over})
    first = lambda c, by: F.min_by(c, F.when(F.col(c).isNotNull(), by))
    per = u.groupBy(*k).agg(
        F.count("*").alias("__u"), F.sum(F.col("end") - F.col("start")).alias("__said"),
        F.count("__h").alias("__hn"), first("__h", F.col("__n")).alias("__h"), F.count("__d").alias("__dn"), first("__d", F.col("__n")).alias("__d"),
        F.count_if(F.col("__s").isNotNull() | F.col("__o").isNotNull()).alias("__sn"), first("__s", F.col("__n")).alias("__s"), first("__o", F.struct("face", "__n")).alias("__o"),
    )
    v = videos.select(*k, F.col("voiced").cast("double").alias("voiced")).join(per, k, "left").join(per_video, k, "left").na.fill(0, ["__u", "__hn", "__dn", "__sn", "__faces", "__bad", "__said"])
    ids = F.when(F.col("__twice").isNotNull(), F.format_string("face id %s appears twice", "__twice")).when(F.col("__reserved"), "F000 is reserved for off-screen speech and cannot be a face track").otherwise(F.col("__d"))
    off = F.col("__said") - F.col("voiced")
    both = F.format_string("attributed %.2fs against VAD %.2fs", "__said", "voiced")
    wrong = F.abs(off) > tolerance
    accounting = F.when(F.col("voiced").isNull(), "no VAD total supplied; accounting not checked").when(wrong, F.concat(both, F.format_string(f" (off by %+.2fs, tolerance {tolerance:.2f}s)", off))).otherwise(both)
    said = lambda text, c: F.format_string(f"%d {text}", c)
    rows = [
        (F.col("__hn"), F.coalesce("__h", said("utterances are renderable", "__u"))),
        (F.col("__bad") + F.col("__dn"), F.coalesce(ids, said("face ids, all referenced ids resolve", "__faces"))),
        (F.col("__sn"), F.coalesce("__s", "__o", said("spans are ordered and in range", "__u"))),
        (F.coalesce(wrong, F.lit(False)).cast("long"), accounting),
    ]
    if scripts is not None:
        v = v.join(_round_trip(utterances, scripts, k), k, "left").na.fill(0, ["__tn"])
        rows.append((F.col("__tn"), F.coalesce("__t", said("utterances round-tripped exactly", "__u"))))
    each = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(GATES[i]).alias("gate"), n.alias("violations"), (n == 0).alias("passed"), detail.alias("detail")) for i, (n, detail) in enumerate(rows)])
    return v.select(*k, F.explode(each).alias("g")).select(*k, "g.*")


def _round_trip(utterances: DataFrame, scripts: DataFrame, k: list[str]) -> DataFrame:
    """``__tn, __t``: how many utterances do not come back from the script as they were, and what is said of it."""
    label = tag(F.col("tag"))
    place = W.partitionBy(*k).orderBy("start", "end", "face")
    sent = utterances.select(*k, (F.row_number().over(place) - 1).alias("position"), "face", label.alias("tag"), "text", unrenderable(F.col("text"), label).alias("__p"))
    back = parse(scripts, k).select(*k, "position", F.col("face").alias("f2"), F.col("tag").alias("t2"), F.col("text").alias("x2"))
    both = sent.join(back, [*k, "position"], "full")
    one, two = F.col("face").isNotNull(), F.col("f2").isNotNull()
    same = F.col("face").eqNullSafe(F.col("f2")) & F.col("tag").eqNullSafe(F.col("t2")) & F.col("text").eqNullSafe(F.col("x2"))
    per = both.groupBy(*k).agg(
        F.count_if(~same).alias("__tn"), F.min_by("__p", F.when(F.col("__p").isNotNull(), F.col("position"))).alias("__p"),
        F.min(F.when(one & two & ~same, F.col("position"))).alias("__at"), F.count_if(one).alias("__one"), F.count_if(two).alias("__two"),
    )
    text = (
        F.when(F.col("__p").isNotNull(), F.concat(F.lit("rendering failed: "), "__p"))
        .when(F.col("__at").isNotNull(), F.format_string("utterance %d changed on round trip", "__at"))
        .when(F.col("__one") != F.col("__two"), F.format_string("round trip produced %d utterances, expected %d", "__two", "__one"))
    )
    return per.select(*k, "__tn", text.alias("__t"))


def report(checked: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row for each video: whether all gates ``passed``, which are ``failing``, and the ``gates`` in order."""
    per = checked.groupBy(*keys).agg(F.min("passed").alias("passed"), F.array_sort(F.collect_list(F.struct("position", "gate", "passed", "detail"))).alias("__g"))
    names = F.transform(F.filter("__g", lambda g: ~g["passed"]), lambda g: g["gate"])
    return per.select(*keys, "passed", names.alias("failing"), F.transform("__g", lambda g: F.struct(g["gate"].alias("name"), g["passed"].alias("passed"), g["detail"].alias("detail"))).alias("gates"))


def metrics(utterances: DataFrame, tracks: DataFrame, videos: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The sixteen reported numbers of each video; ratios are 0 where nothing divides.

    ``utterances``: face, tag, text, flags, start, end; ``tracks``: face, speaks; ``videos``: duration.
    """
    k = list(keys)
    length, on = F.col("end") - F.col("start"), F.col("face") != "F000"
    per = utterances.groupBy(*k).agg(
        F.count("*").alias("utterance_count"),
        F.sum(F.when(on, length).otherwise(0)).alias("face_speech_seconds"),
        F.sum(F.when(~on, length).otherwise(0)).alias("offscreen_speech_seconds"),
        F.sum(length).alias("speech_seconds"),
        F.avg(length).alias("mean_utterance_seconds"),
        F.max(length).alias("max_utterance_seconds"),
        F.count_if(F.array_contains("flags", "short")).alias("short_utterance_count"),
        F.count_if(F.coalesce("tag", F.lit("")) != "").alias("tagged_utterance_count"),
        F.count_if(F.trim(F.coalesce("text", F.lit(""))) == "").alias("empty_text_count"),
    )
    faces = tracks.groupBy(*k).agg(F.count("*").alias("face_count"), F.count_if("speaks").alias("speaking_face_count"))
    whole = union_length(utterances, k).withColumnRenamed("length", "utterance_union_seconds")
    shared = depth(utterances, "face", k).where("owners >= 2").groupBy(*k).agg(F.sum(length).alias("overlap_seconds"))
    found = videos.select(*k, "duration")
    for part in (per, faces, whole, shared):
        found = found.join(part, k, "left")
    found = found.na.fill(0)
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    ratios = {"speech_ratio": share("speech_seconds", "duration"), "assigned_ratio": share("face_speech_seconds", "speech_seconds"), "overlap_ratio": share("overlap_seconds", "utterance_union_seconds")}
    return found.withColumns(ratios).drop("duration")
