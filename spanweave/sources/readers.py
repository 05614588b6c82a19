"""Readers and writers of the annotation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEDIA = ("mp4", "mkv", "mov", "avi", "webm", "m4v")

#: Schemas of the tables; readers never infer them.
SCHEMAS = {
    "videos": "video_id string, path string, duration double, audio_duration double, audio_delta double, fps double, frame_count long, width int, height int, sample_rate int, channels int, has_audio boolean",
    "cuts": "video_id string, t double",
    "shots": "video_id string, index int, start double, end double, caption string",
    "detections": "video_id string, frame long, time double, faces array<struct<x:double,y:double,w:double,h:double,score:double,landmarks:array<struct<x:double,y:double>>,emb:int>>",
    "embeddings": "video_id string, emb int, vec array<float>",
    "tracklets": "video_id string, track_id int, start_frame long, end_frame long, hits int, quality struct<frames:int,span_seconds:double,mean_score:double,mean_width:double,mean_height:double,motion:double>, detections array<struct<frame:long,time:double,x:double,y:double,w:double,h:double,score:double,emb:int>>",
    "turns": "video_id string, speaker string, start double, end double",
    "speaking": "video_id string, track_id int, samples array<struct<time:double,probability:double>>",
    "assignments": "video_id string, speaker string, face_id string, score double, margin double, coverage double, candidate string, ambiguous boolean, merged boolean, reason string",
    "segments": "video_id string, identity string, index int, name string, start double, end double, duration double, flags array<string>, audio string, rms double, silent boolean",
    "transcripts": "video_id string, name string, text string, words array<struct<text:string,start:double,end:double,probability:double>>, language string, language_probability double, detected boolean, avg_logprob double, no_speech_prob double, compression_ratio double, flags array<string>",
    "tag_scores": "video_id string, name string, dimension string, label string, score double",
    "tags": "video_id string, name string, tag string, dimension string, score double, margin double, reason string",
    "stage_state": "video_id string, stage string, status string, code_version string, config_hash string, input_hash string, artifacts array<struct<path:string,sha256:string,size:long>>, error string, finished_at timestamp",
}


def read_lines(spark: SparkSession, path: str, name: str, strict: bool = True) -> DataFrame:
    """A JSON-lines table by its fixed schema; blank lines do not count, bad ones fail if strict."""
    return spark.read.schema(SCHEMAS[name]).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def write_lines(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = "video_id") -> None:
    """A JSON-lines table, a folder for each video; the committer leaves old data until all is written."""
    writer = df.write.mode(mode)
    (writer.partitionBy(by) if by else writer).json(path)


def is_media(path):
    """Whether a path names a media file that is not hidden."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return ~name.startswith(".") & F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).isin(*MEDIA)


def stem(path):
    """A path's file name without its suffix."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def media_list(entries: DataFrame, files: DataFrame) -> DataFrame:
    """``position, entry, path, problem``: the entries of a list file resolved against files.

    ``entries`` has position and value (a line each), ``files`` has path.  Comments and blank lines
    do not count and repeated entries count once, at their first place.  An entry is a path, or a
    path without its media suffix; one that fits no file or several gets a problem.
    """
    said = entries.select("position", F.trim("value").alias("entry")).where("entry <> '' and entry not like '#%'").groupBy("entry").agg(F.min("position").alias("position"))
    media = files.where(is_media(F.col("path"))).select("path", F.regexp_replace("path", r"\.[^./]*$", "").alias("bare"))
    exact = said.join(files.select("path"), F.col("entry") == F.col("path"), "left")
    loose = exact.where("path is null").drop("path").join(media, F.col("entry") == F.col("bare"), "left").groupBy("position", "entry").agg(F.collect_set("path").alias("paths"))
    problem = F.when(F.size("paths") == 0, "missing").when(F.size("paths") > 1, "ambiguous")
    found = loose.select("position", "entry", F.when(problem.isNull(), F.get("paths", F.lit(0))).alias("path"), problem.alias("problem"))
    return exact.where("path is not null").select("position", "entry", "path", F.lit(None).cast("string").alias("problem")).unionByName(found)


def read_media_list(spark: SparkSession, list_path: str, root: str) -> DataFrame:
    """``media_list`` of a list file and the files below a folder; fails on entries with a problem."""
    entries = spark.read.text(list_path).withColumn("position", F.monotonically_increasing_id())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_replace("path", "^file:", "").alias("path"))
    rows = entries.withColumn("value", F.when(F.trim("value").startswith("/") | F.trim("value").startswith("#") | (F.trim("value") == ""), F.trim("value")).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), F.trim("value"))))
    found = media_list(rows, files)
    stop = F.raise_error(F.format_string("%s: %s", "problem", "entry"))
    return found.withColumn("path", F.when(F.col("problem").isNotNull(), stop).otherwise(F.col("path"))).drop("problem")


def read_stored(spark: SparkSession, root: str, name: str, made_by: str | None = None, kind: str = "json") -> DataFrame:
    """A stage's table below ``root`` by its fixed schema; one that is not there names the stage to run first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{name}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"there is no {path.toString()}" + (f"; run {made_by} first" if made_by else ""))
    reader = spark.read.schema(SCHEMAS[name])
    return reader.json(path.toString(), mode="FAILFAST") if kind == "json" else reader.parquet(path.toString())


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``path, text`` of JSON documents, each file whole."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


RECORDS = "struct<stages:array<struct<stage:string,status:string,code_version:string,config_hash:string,input_hash:string,error:string,artifacts:array<struct<path:string,sha256:string,size:long>>>>>"


def stage_states(documents: DataFrame) -> DataFrame:
    """Stage records from state documents (``video_id, text``); a document that is no JSON has none."""
    parsed = documents.select("video_id", F.from_json("text", RECORDS, {"mode": "PERMISSIVE"}).alias("d"))
    return parsed.select("video_id", F.posexplode("d.stages").alias("position", "r")).select("video_id", "position", "r.*").where("stage is not null")


def vectors(rows: DataFrame, column: str = "vec") -> DataFrame:
    """Vectors stored as little-endian half floats (binary) as float arrays; without bytes none.

    The bits of each number are taken apart in SQL: sign, five of exponent, ten of fraction.
    """
    def number(w):
        sign = F.when(F.shiftrightunsigned(w, 15) == 1, -1.0).otherwise(1.0)
        power, fraction = F.shiftrightunsigned(w, 10).bitwiseAND(F.lit(31)), w.bitwiseAND(F.lit(1023))
        value = F.when(power == 0, fraction * F.lit(2.0**-24)).when(power == 31, F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))).otherwise((1 + fraction / 1024) * F.pow(F.lit(2.0), power - 15))
        return (sign * value).cast("float")

    n = F.floor(F.length(column) / 2).cast("int")
    digits = F.hex(F.col(column))
    words = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.concat(F.substring(digits, i * 4 + 3, F.lit(2)), F.substring(digits, i * 4 + 1, F.lit(2))), 16, 10).cast("int"))
    return rows.withColumn(column, F.when(n > 0, F.transform(words, number)))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """``path, sha256, size`` of the files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))
