"""Media read through outside programs' answers: probes, cuts, encoders, frames to look at, and sound.

The programs themselves are not part of the engine.  What they print comes as text columns and is
read with column expressions; WAV files come as bytes (``binaryFile``) and are read on the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import audio as A
from ..shipping import ship

#: Encoders from the best to the one that does.
ENCODERS = ("libx264", "libopenh264", "h264_nvenc", "libx265", "mpeg4")


def rate(c: Column) -> Column:
    """A frame rate like ``30000/1001`` or ``25``; 0 of what is none."""
    a, b = F.split_part(c, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(c, F.lit("/"), F.lit(2))
    below = F.when(b == "", F.lit(1.0)).otherwise(b.try_cast("double"))
    return F.coalesce(F.when(below != 0, a / below), F.lit(0.0))


def probes(answers: DataFrame) -> DataFrame:
    """What a prober's JSON (``video_id, probe``) says: ``duration, fps, width, height, frame_count, sample_rate,
    channels, has_audio``, or a ``problem``.

    The duration is the container's, else the video stream's; without a count of frames it is the
    duration times the rate, rounded.
    """
    stream = "array<struct<codec_type:string,duration:string,nb_frames:string,r_frame_rate:string,avg_frame_rate:string,width:int,height:int,sample_rate:string,channels:int>>"
    parsed = answers.withColumn("__p", F.from_json("probe", f"struct<streams:{stream},format:struct<duration:string>>"))
    first = lambda kind: F.get(F.filter("__p.streams", lambda s: s["codec_type"] == kind), F.lit(0))
    both = parsed.withColumns({"__v": first("video"), "__a": first("audio")})
    duration = F.coalesce(F.col("__p.format.duration").try_cast("double"), F.col("__v.duration").try_cast("double"), F.lit(0.0))
    fps = rate(F.col("__v.r_frame_rate"))
    counted = F.coalesce(F.col("__v.nb_frames").try_cast("long"), F.lit(0))
    frames = F.when(counted > 0, counted).otherwise(F.bround(duration * fps).cast("long"))
    problem = F.when(F.col("__v").isNull(), "no video stream").when(duration <= 0, "no duration")
    whole = lambda c: F.coalesce(F.col(c).try_cast("int"), F.lit(0))
    return both.select(
        "video_id", duration.alias("duration"), F.coalesce(F.nullif(fps, F.lit(0.0)), rate(F.col("__v.avg_frame_rate"))).alias("fps"), whole("__v.width").alias("width"), whole("__v.height").alias("height"),
        frames.alias("frame_count"), whole("__a.sample_rate").alias("sample_rate"), whole("__a.channels").alias("channels"), F.col("__a").isNotNull().alias("has_audio"), problem.alias("problem"),
    )


def cuts(logs: DataFrame) -> DataFrame:
    """``video_id, t``: the times of cuts in a scene filter's log (``video_id, log``)."""
    times = F.regexp_extract_all("log", F.lit(r"pts_time:\s*(\S+)"), F.lit(1))
    return logs.select("video_id", F.explode(times).alias("__t")).select("video_id", F.col("__t").try_cast("double").alias("t")).where("t is not null")


def encoder_names(listing: str) -> set[str]:
    """Names in a listing of encoders: second words of lines that begin with flags."""
    words = (line.split() for line in listing.splitlines())
    return {w[1] for w in words if len(w) > 1 and w[0][:1] in "VAS" and "." in w[0]}


def choose_encoder(available: Iterable[str]) -> str:
    """The best encoder that is there."""
    have = set(available)
    for name in ENCODERS:
        if name in have:
            return name
    raise ValueError(f"there is none of the encoders {', '.join(ENCODERS)}")


def sampled_frames(videos: DataFrame, stride: int = 3) -> DataFrame:
    """``video_id, frame``: every ``stride``-th frame of each video (``frame_count``)."""
    if stride < 1:
        raise ValueError(f"a stride must be at least 1, got {stride}")
    some = videos.where("frame_count > 0")
    return some.select("video_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("frame_count") - 1, F.lit(stride).cast("long"))).alias("frame"))


def quiet_tail(c: Column, lines: int = 5) -> Column:
    """The last lines of what a program said, on one line."""
    every = F.split(F.regexp_replace(c, r"(\r\n|\r|\n)$", ""), r"\r\n|\r|\n")
    return F.array_join(F.when(F.size(every) > lines, F.slice(every, -lines, lines)).otherwise(every), " | ")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, content`` of the WAV files below a folder, on any file system that Spark reads."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.wav").load(path).select("path", "content")


def _map(rows: DataFrame, one: Callable[[dict], dict], schema: str) -> DataFrame:
    """A Python function of each row, with its failure in the row's ``error``; rows come in Arrow batches."""
    ship(rows.sparkSession)
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                try:
                    out.append({**dict.fromkeys(names), **row, **one(row)})
                except Exception as why:  # the row's own failure
                    out.append({**dict.fromkeys(names), **row, "error": f"{type(why).__name__}: {why}"})
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(work, schema)


def wav_headers(files: DataFrame) -> DataFrame:
    """``path, sample_rate, frames, channels, error`` of WAV files (``path, content``)."""
    read = lambda row: dict(zip(("sample_rate", "frames", "channels"), A.wav_info(row["content"]), strict=True))
    return _map(files, read, "path string, sample_rate double, frames double, channels double, error string").select("path", *[F.col(c).cast("long").alias(c) for c in ("sample_rate", "frames", "channels")], "error")


def segment_samples(segments: DataFrame, files: DataFrame, sample_rate: int = 16_000) -> DataFrame:
    """``video_id, name, samples, rms, silent, error``: each segment's sound from its file.

    ``segments``: video_id, name, path, origin, file_origin, seconds.  A file that is not there, of
    another rate, or too short is the segment's own error.
    """
    both = segments.join(files.withColumnRenamed("path", "__path"), F.col("path") == F.col("__path"), "left").drop("__path")

    def read(row: dict) -> dict:
        if row["content"] is None:
            raise FileNotFoundError(f"no audio at {row['path']}")
        samples = A.segment_audio(row["content"], row["origin"], row["file_origin"], row["seconds"], sample_rate)
        loud = A.rms(samples)
        return {"samples": samples.tolist(), "rms": loud, "silent": loud < 1e-4}

    return _map(both, read, "video_id string, name string, samples array<float>, rms double, silent boolean, error string")


def wav_files(samples: DataFrame, sample_rate: int = 16_000) -> DataFrame:
    """``path, content, error``: samples (``path, samples``) as WAV files in memory, to be written by a sink."""
    return _map(samples, lambda row: {"content": A.wav_bytes(row["samples"], sample_rate)}, "path string, content binary, error string")
