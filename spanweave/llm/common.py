"""Helpers shared by the training-data operators: table access, intermediate tables, Arrow batches.

Every operator here takes and returns DataFrames.  Operators that run Python on the executors
receive Arrow record batches, which Spark bounds in rows and in bytes, work on slices of a few
rows of them and keep no state that grows with the partition unless their docstring states the
bound.  The session's settings are left as they are.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanweave.shipping import ship
from spanweave.storage import cut, forget

__all__ = ["BATCH_ROWS", "crc32_sql", "cut", "forget", "kept", "map_batches", "n_partitions", "release", "runs", "table", "text_of"]

#: Rows of an Arrow batch that a Python function handles at a time.
BATCH_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the input folder, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
    rows: int = BATCH_ROWS,
    keeps: bool = False,
) -> DataFrame:
    """``mapInArrow`` with one function per task: ``make()`` is called on the executor.

    The function gets ``rows`` rows at a time.  keeps: ``make`` uses ``kept``; otherwise what earlier
    tasks kept in the worker goes first.
    """
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            release()
        step = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                yield step(batch.slice(at, rows))

    return df.mapInArrow(run, schema)


_KEPT: dict[Hashable, object] = {}


def kept(key: Hashable, build: Callable[[], object]) -> object:
    """What ``build()`` gives, kept in the worker process for its next tasks; one thing at a time."""
    if key not in _KEPT:
        release()
        _KEPT[key] = build()
    return _KEPT[key]


def release() -> None:
    """Drop what tasks before kept in the worker process.

    Spark uses a worker again for any later stage, where a vocabulary with a million words encoded
    would lie idle beside what that stage needs.
    """
    if _KEPT:
        _KEPT.clear()
        gc.collect()
        # What was freed goes back to the machine, where the C library can do so.
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def runs(batches: Iterator[pa.RecordBatch], column: int = 0) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """Of rows that are sorted by a column: each run of its values within a batch, as (value, whether it is
    the first run of that value, the rows).  Null is a value like any other."""
    now: object = ...
    for batch in batches:
        if not batch.num_rows:
            continue
        coded = pc.run_end_encode(batch.column(column))
        at = 0
        for value, end in zip(coded.values.to_pylist(), coded.run_ends.to_pylist(), strict=True):
            yield value, now is ... or value != now, batch.slice(at, end - at)
            now, at = value, end


def n_partitions(spark: SparkSession) -> int:
    """The shuffle width the session asks for; operators never use fewer."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: str = "text"):
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the crc32 of a string expression, bit by bit, as DuckDB has no function for it."""
    bits = f"list_transform(range(8), lambda bit_no: (('0x' || substr(hex(encode({text})), 2 * byte_no::INT + 1, 2))::BIGINT >> bit_no::INT) & 1)"
    every = f"list_prepend(4294967295::BIGINT, flatten(list_transform(range(octet_length(encode({text}))), lambda byte_no: {bits})))"
    return f"xor(list_reduce({every}, lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"
