"""Sound read by byte ranges: windows and spans of WAV files of any length.

Whole files (``media.read_files``) are rows of at most 2 GB.  Here a table of paths becomes a table of
headers and then one of windows, dealt over tasks by Spark, and each task reads the bytes of its own windows
alone.  Workers open files through pyarrow's file systems: a plain path or ``file:`` is a folder that
executors share, other schemes (``hdfs:``, ``s3:``, ``gs:``) are what pyarrow is built with.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import audio as A
from ..shipping import ship

#: Windows of an Arrow batch that a worker holds at a time.
ROWS = 64


def opened(path: str) -> pa.NativeFile:
    """A file to read at any place."""
    if ":" in path.split("/", 1)[0]:
        if path.startswith("file:"):
            return pa.fs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
        system, name = pa.fs.FileSystem.from_uri(path)
        return system.open_input_file(name)
    return pa.fs.LocalFileSystem().open_input_file(path)


def head_of(file: pa.NativeFile) -> tuple[int, int, int, int]:
    """Sample rate, frames, channels of a PCM16 WAV file, and where its samples begin.

    Chunks before the samples are passed over.  A data chunk that says more than the file holds, or nothing
    sensible, as those of recordings over 4 GB do, reaches to the file's end.
    """
    size = file.size()
    if file.read_at(4, 0) not in (b"RIFF", b"RF64") or file.read_at(4, 8) != b"WAVE":
        raise ValueError("the file is not WAV")
    at, form = 12, None
    while at + 8 <= size:
        name, length = struct.unpack("<4sI", file.read_at(8, at))
        if name == b"fmt ":
            form = struct.unpack("<HHIIHH", file.read_at(16, at + 8))
        elif name == b"data":
            if form is None or form[0] not in (1, 0xFFFE) or form[5] != 16:
                raise ValueError("the file is not PCM16")
            there = size - at - 8
            length = there if length == 0xFFFFFFFF or length > there else length
            return form[2], length // (2 * form[1]), form[1], at + 8
        at += 8 + length + (length & 1)
    raise ValueError("the file has no samples")


def heads(files: DataFrame) -> DataFrame:
    """``path, sample_rate, frames, channels, offset, error`` of the files of a table with ``path``.

    A file that cannot be read has an error and nulls.  Only headers are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                try:
                    with opened(path) as f:
                        out.append((path, *head_of(f), None))
                except Exception as why:  # the row's own failure
                    out.append((path, None, None, None, None, f"{type(why).__name__}: {why}"))
            types = [pa.string(), *[pa.int64()] * 4, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["path", "sample_rate", "frames", "channels", "offset", "error"])

    ship(files.sparkSession)
    return files.select("path").mapInArrow(run, "path string, sample_rate long, frames long, channels long, offset long, error string")


def spans(rows: DataFrame, sample_rate: int | None = None, wav: bool = False) -> DataFrame:
    """Rows (``path, start, seconds``, seconds from the file's beginning) with ``samples`` and ``error``.

    With ``wav`` instead of samples ``audio``, the span as a WAV file in memory, and its ``rms``.

    Samples are floats in [-1, 1], of the first channel, cut to the file.  A file that is not there, of
    another rate than asked, or a span without samples is the row's error.  A file is opened once for rows
    of it that stand together.  Null path, start or seconds: an error.  Memory is that of ``ROWS`` spans.
    """
    at = {c: rows.columns.index(c) for c in ("path", "start", "seconds")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, of, head = None, None, None
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                found, errors, rates = [], [], []
                for path, start, seconds in zip(*(part.column(i).to_pylist() for i in at.values()), strict=True):
                    try:
                        if None in (path, start, seconds):
                            raise ValueError("a span needs a path, a start and a length")
                        if of != path:
                            of, file = None, opened(path)
                            head, of = head_of(file), path
                        rate, frames, channels, offset = head
                        if sample_rate is not None and rate != sample_rate:
                            raise ValueError(f"the file has {rate} Hz but {sample_rate} Hz were expected")
                        begin = min(round(max(0.0, start) * rate), frames)
                        n = max(0, min(round(seconds * rate), frames - begin))
                        if not n:
                            raise ValueError(f"reading {start:.3f}s+{seconds:.3f}s yielded no samples")
                        raw = np.frombuffer(file.read_at(n * 2 * channels, offset + begin * 2 * channels), "<i2")
                        found.append(raw.reshape(-1, channels)[:, 0].astype(np.float32) / A.SCALE)
                        errors.append(None)
                        rates.append(rate)
                    except Exception as why:  # the row's own failure
                        found.append(None)
                        errors.append(f"{type(why).__name__}: {why}")
                        rates.append(None)
                if wav:
                    files = [None if x is None else A.wav_bytes(x, rate) for x, rate in zip(found, rates, strict=True)]
                    made = [pa.array(files, pa.binary()), pa.array([None if x is None else A.rms(x) for x in found], pa.float64())]
                else:
                    made = [pa.array(found, pa.list_(pa.float32()))]
                yield pa.RecordBatch.from_arrays([*part.columns, *made, pa.array(errors, pa.string())], [*part.schema.names, *names, "error"])

    ship(rows.sparkSession)
    names = ("audio", "rms") if wav else ("samples",)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, {'audio binary, rms double' if wav else 'samples array<float>'}, error string")


def windows(files: DataFrame, seconds: float, step: float | None = None, sample_rate: int | None = None) -> DataFrame:
    """``path, index, start, seconds, samples, error``: each file cut into windows, ``step`` apart (as long as they are).

    The last window ends with the file.  Windows, not files, are dealt over the tasks, so one file of days is
    read by as many as there are.  A file that cannot be read is one row with its error.
    """
    if seconds <= 0 or (step is not None and step <= 0):
        raise ValueError("windows need a length and a step")
    step = step or seconds
    found = heads(files)
    length = F.col("frames") / F.col("sample_rate")
    last = F.greatest(F.ceil((length - F.lit(seconds)) / F.lit(step)), F.lit(0)).cast("long")
    index = F.when(F.col("error").isNull(), F.sequence(F.lit(0).cast("long"), last)).otherwise(F.array(F.lit(0).cast("long")))
    rows = found.select("path", F.explode(index).alias("index")).withColumns({"start": F.col("index") * F.lit(float(step)), "seconds": F.lit(float(seconds))})
    dealt = rows.repartition("path", (F.col("index") / ROWS).cast("long")).sortWithinPartitions("path", "index")
    return spans(dealt, sample_rate)
