"""Spectra of sound that comes in pieces, and the speakers' axis of a model's input."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import audio as A
from ..shipping import ship
from .intervals import KEYS

#: Rows of features of an Arrow batch.
ROWS = 1024
#: Samples of pieces that a task takes at once, or one piece.
SAMPLES = 1 << 20


def slices(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices whose lists in column ``at`` hold ``SAMPLES`` together at most, or of one row."""
    ends = batch.column(at).offsets.to_numpy().astype(np.int64)
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + SAMPLES, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def firsts(columns: Sequence[pa.Array], rows: int) -> np.ndarray:
    """The first row of each run of rows alike in all columns; null equals null."""
    other = np.zeros(max(0, rows - 1), bool)
    for c in columns:
        a, b = c.slice(1), c.slice(0, rows - 1)
        differ = np.asarray(pc.fill_null(pc.not_equal(a, b), False))
        other |= differ | (np.asarray(a.is_null()) != np.asarray(b.is_null()))
    return np.r_[0, np.flatnonzero(other) + 1]


def features(pieces: DataFrame, keys: Sequence[str] = KEYS, at: str = "index", samples: str = "samples", sample_rate: int = 16_000, fps: float = A.BASE_FPS) -> DataFrame:
    """``keys, row, features``: log-mel features of each key's sound, a row for each hop, from 0 on.

    A key's pieces follow one another in the order of ``at``, without gaps, and may be of any length: what a
    frame lacks of the next piece is carried over to it, so the rows are those of the whole sound.  A task
    holds an Arrow batch, of it ``SAMPLES`` (or one piece) as numbers, and less than a frame.  Null pieces count as empty; a sound under a frame has no row.
    """
    k = list(keys)
    kind = {f.name: f.dataType.simpleString() for f in pieces.schema}
    frame, hop = A.frame_sizes(sample_rate, fps)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, carried, row = None, np.empty(0, np.float32), 0
        for batch in (part for whole in batches for part in slices(whole, len(k))):
            column = batch.column(len(k))
            length = np.where(np.asarray(column.is_valid()), np.diff(column.offsets.to_numpy()), 0)
            sound = column.flatten().to_numpy(zero_copy_only=False)
            # The sounds of keys lie one after the other; what the key before lacked comes in front of its own.
            first = firsts([batch.column(i) for i in range(len(k))], batch.num_rows)
            ends = np.r_[np.cumsum(length)[first[1:] - 1], len(sound)].astype(np.int64)
            starts = np.r_[0, ends[:-1]].astype(np.int64)
            done = np.zeros(len(first), np.int64)
            key = tuple(batch.column(i)[0].as_py() for i in range(len(k)))
            if now == key:
                sound, done[0] = np.concatenate([carried, sound]), row
                ends += len(carried)
                starts[1:] += len(carried)
            n = np.maximum(0, (ends - starts - frame) // hop + 1)
            owner = np.repeat(np.arange(len(first)), n)
            step = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
            at = starts[owner] + step * hop
            for part in range(0, len(at), ROWS):
                own, where = owner[part : part + ROWS], at[part : part + ROWS]
                some = A.mel_of(sound[where[:, None] + np.arange(frame)], sample_rate)
                keyed = [batch.column(i).take(pa.array(first[own])) for i in range(len(k))]
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * some.shape[1]), pa.array(some.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*keyed, pa.array(done[own] + step[part : part + ROWS]), flat], [*k, "row", "features"])
            now, row = tuple(batch.column(i)[batch.num_rows - 1].as_py() for i in range(len(k))), int(done[-1] + n[-1])
            carried = sound[starts[-1] + n[-1] * hop : ends[-1]].copy()

    ship(pieces.sparkSession)
    ordered = pieces.select(*k, at, samples).repartition(*k).sortWithinPartitions(*k, at).select(*k, F.col(samples).cast(kind[samples] if kind[samples] == "array<double>" else "array<float>").alias(samples))
    return ordered.mapInArrow(run, ", ".join(f"`{c}` {kind[c]}" for c in k) + ", row long, features array<double>")


def padded(rows: DataFrame, keys: Sequence[str], width: int, order: Sequence[str], empty: Column, value: str = "features") -> DataFrame:
    """``keys, slot, value``: the rows of each key on an axis of ``width``, in order, and ``empty`` where there is none.

    A key of more rows than the axis has fails.  The axis is made of the keys and joined with the rows.
    """
    if width < 1:
        raise ValueError(f"an axis needs at least one slot, not {width}")
    k = list(keys)
    listed = rows.groupBy(*k).agg(F.count("*").alias("__n"))
    too_many = F.raise_error(F.format_string(f"%d speakers do not fit an axis of {width}", "__n")).cast("array<int>")
    slots = listed.select(*k, F.explode(F.when(F.col("__n") > width, too_many).otherwise(F.sequence(F.lit(0), F.lit(width - 1)))).alias("slot"))
    placed = rows.select(*k, (F.row_number().over(W.partitionBy(*k).orderBy(*order)) - 1).alias("slot"), F.col(value).alias("__v"))
    return slots.join(placed, [*k, "slot"], "left").select(*k, "slot", F.coalesce("__v", empty).alias(value))
