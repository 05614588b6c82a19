"""The annotation document: written from tables as JSON text, and read back strictly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tag
from .intervals import KEYS

VERSION = "spanweave-annotation-v1"
NAMES = {"STRING": "str", "BOOLEAN": "bool", "VOID": "NoneType", "BIGINT": "int", "DOUBLE": "float"}
SHOTS = "array<struct<index:int,start:double,end:double,caption:string>>"
UTTERANCES = "array<struct<face_id:string,start:double,end:double,text:string,tag:string,audio_path:string,words:array<struct<text:string,start:double,end:double>>,confidence:double,flags:array<string>>>"
TRACKS = "array<struct<face_id:string,first_seen:double,last_seen:double,speaks:boolean,total_speech:double,tracklets:array<string>,quality:map<string,double>>>"


def documents(videos: DataFrame, shots: DataFrame, utterances: DataFrame, tracks: DataFrame, keys: Sequence[str] = KEYS, version: str = VERSION) -> DataFrame:
    """One JSON ``document`` for each video, numbers rounded to four places.

    ``videos``: path, duration, fps, width, height, caption, language (struct of code, confidence,
    source; null: left out); ``shots``: index, start, end, caption; ``utterances``: face, start, end,
    text, tag, audio, words (text, start, end), confidence, flags; ``tracks``: face, first_seen,
    last_seen, speaks, total_speech, tracklets, quality.  A document holds its video's rows in one list
    each: shots by index, utterances by start, end and face, tracks by face.
    """
    k = list(keys)
    four = lambda c: F.bround(c.cast("double"), 4)
    ordered = lambda rows, by, *values: rows.groupBy(*k).agg(F.transform(F.array_sort(F.collect_list(F.struct(*by, F.struct(*values).alias("row")))), lambda x: x["row"]).alias("rows"))
    c = F.col
    shot = ordered(shots, [c("index").alias("a")], "index", four(c("start")).alias("start"), four(c("end")).alias("end"), F.coalesce("caption", F.lit("")).alias("caption"))
    words = F.transform("words", lambda w: F.struct(w["text"].alias("text"), four(w["start"]).alias("start"), four(w["end"]).alias("end")))
    said = ordered(
        utterances, [c("start").alias("a"), c("end").alias("b"), c("face").alias("c")],
        c("face").alias("face_id"), four(c("start")).alias("start"), four(c("end")).alias("end"), "text", tag(c("tag")).alias("tag"), c("audio").alias("audio_path"),
        F.coalesce(words, F.array().cast("array<struct<text:string,start:double,end:double>>")).alias("words"), four(c("confidence")).alias("confidence"), F.coalesce("flags", F.array().cast("array<string>")).alias("flags"),
    )
    entries = F.array_sort(F.transform(F.map_entries("quality"), lambda e: F.struct(e["key"].alias("key"), four(e["value"]).alias("value"))))
    seen = ordered(tracks, [c("face").alias("a")], c("face").alias("face_id"), four(c("first_seen")).alias("first_seen"), four(c("last_seen")).alias("last_seen"), "speaks", four(c("total_speech")).alias("total_speech"), "tracklets", entries.alias("quality"))
    # Maps cannot be sorted, so qualities become maps after the sort.
    seen = seen.withColumn("rows", F.transform("rows", lambda r: r.withField("quality", F.map_from_entries(r["quality"]))))
    both = videos
    for name, part in (("shots", shot), ("utterances", said), ("face_tracks", seen)):
        both = both.join(part.withColumnRenamed("rows", f"__{name}"), k, "left")
    video = F.struct(c(k[0]).cast("string").alias("video_id"), "path", four(c("duration")).alias("duration"), four(c("fps")).alias("fps"), "width", "height")
    lists = [F.coalesce(c(f"__{n}"), F.array().cast(part.schema["rows"].dataType)).alias(n) for n, part in (("shots", shot), ("utterances", said), ("face_tracks", seen))]
    body = F.to_json(F.struct(F.lit(version).alias("schema_version"), video.alias("video"), *lists, F.coalesce("caption", F.lit("")).alias("global_caption")), {"ignoreNullFields": "false"})
    spoken = F.to_json(F.struct(c("language.code").alias("code"), four(c("language.confidence")).alias("confidence"), c("language.source").alias("source")), {"ignoreNullFields": "false"})
    text = F.when(c("language").isNull(), body).otherwise(F.concat(F.expr("substring(__b, 1, length(__b) - 1)"), F.lit(',"language":'), spoken, F.lit("}")))
    return both.withColumn("__b", body).select(*k, text.alias("document"))


def _kind(v: Column) -> Column:
    """What a JSON value is, as Python names it; null where there is none."""
    name = F.regexp_extract(F.schema_of_variant(v), r"^([A-Z]+)", 1)
    return F.when(name == "OBJECT", "dict").when(name == "ARRAY", "list").when(name == "DECIMAL", "float").otherwise(F.coalesce(*[F.when(name == k, n) for k, n in NAMES.items()], F.lower(name)))


def number_problem(v: Column, field: str) -> Column:
    """Why a JSON value is no number; numbers as text are accepted, truth values are not."""
    kind = _kind(v)
    bad = F.concat(F.lit(f"{field} must be a number, got "), kind)
    text = F.try_variant_get(v, "$", "string")
    return F.when(kind.isin("int", "float"), None).when(kind == "str", F.when(text.try_cast("double").isNull(), F.concat(F.lit(f"{field} is not a number: '"), text, F.lit("'")))).otherwise(bad)


def _entry_problem(e: Column, field: str, texts: Sequence[str], numbers: Sequence[str], optional: Sequence[str] = ()) -> Column:
    at = lambda key: F.try_variant_get(e, f"$.{key}", "variant")
    found = [F.when(_kind(e) != "dict", F.concat(F.lit(f"{field.removesuffix('[]')} entries must be objects, got "), _kind(e)))]
    for key in (*texts, *numbers):
        missing = F.lit(f"{field} is missing required key '{key}'")
        found.append(F.when(at(key).isNull(), missing).otherwise(number_problem(at(key), f"{field}.{key}") if key in numbers else F.lit(None).cast("string")))
    found += [F.when(at(key).isNotNull() & (_kind(at(key)) != "NoneType"), number_problem(at(key), f"{field}.{key}")) for key in optional]
    return F.coalesce(*found)


def read_documents(texts: DataFrame, keys: Sequence[str] = KEYS, version: str = VERSION) -> DataFrame:
    """Documents (``document``) as columns ``video, shots, utterances, face_tracks, caption, language``, and
    the first ``problem`` that keeps one from being read, with the field's name; null where it was read.

    Strict about what rendering depends on, and lenient about further fields.  Texts that are no JSON
    have a problem too and do not stop the others.
    """
    v = F.try_parse_json("document")
    parsed = texts.withColumn("__v", v)
    at = lambda path, kind="variant": F.try_variant_get("__v", f"$.{path}", kind)

    def listed(name: str, texts_: Sequence[str], numbers: Sequence[str], optional: Sequence[str] = ()) -> Column:
        kind = _kind(at(name))
        rows = at(name, "array<variant>")
        first = F.get(F.filter(F.transform(rows, lambda e: _entry_problem(e, f"{name}[]", texts_, numbers, optional)), lambda p: p.isNotNull()), F.lit(0))
        return F.when(at(name).isNull() | (kind == "NoneType"), None).when(kind != "list", F.concat(F.lit(f"{name} must be a list, got "), kind)).otherwise(first)

    found = at("schema_version", "string")
    problem = F.coalesce(
        F.when(F.col("__v").isNull(), "annotation is not JSON"),
        F.when(found.isNull(), "annotation has no schema_version").when(found != version, F.concat(F.lit("annotation schema_version is '"), found, F.lit(f"', expected '{version}'"))),
        F.when(at("video").isNull() | (_kind(at("video")) != "dict"), "annotation has no video block"),
        F.when(at("language").isNotNull() & (_kind(at("language")) == "dict") & at("language.code").isNull(), "language is missing required key 'code'"),
        listed("shots", (), ("index", "start", "end")),
        listed("utterances", ("face_id",), ("start", "end"), ("confidence",)),
        F.get(F.filter(F.transform(at("utterances", "array<variant>"), lambda e: F.when(F.try_variant_get(e, "$.text", "variant").isNull(), "utterances[] is missing required key 'text'")), lambda p: p.isNotNull()), F.lit(0)),
        listed("face_tracks", ("face_id",), ("first_seen", "last_seen"), ("total_speech",)),
    )
    good = F.col("problem").isNull()
    own = lambda path, kind: F.when(good, at(path, kind))
    some = lambda path, kind: F.when(good, F.coalesce(at(path, kind), F.array().cast(kind)))
    read = parsed.withColumn("problem", problem)
    return read.select(
        *keys, "problem",
        own("video", "struct<video_id:string,path:string,duration:double,fps:double,width:int,height:int>").alias("video"),
        some("shots", SHOTS).alias("shots"), some("utterances", UTTERANCES).alias("utterances"), some("face_tracks", TRACKS).alias("face_tracks"),
        own("global_caption", "string").alias("caption"), own("language", "struct<code:string,confidence:double,source:string>").alias("language"),
    )
