"""Chat formatting by token-level assembly.

Each turn's content is encoded on its own and reserved ids, which no content can produce, are
spliced around it.  The loss mask is kept as +1/-1 steps at the ends of the learned segments and
derived by a prefix sum.  Control strings that occur in content are escaped, so the rendered text
can be read back as well as the ids.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import load
from .common import BATCH_ROWS, map_batches, n_partitions

#: The template's control strings, in the order of their reserved ids after the vocabulary's last.
CONTROLS = ("### System:", "### User:", "### Assistant:", "### Role:", "### Text:", "</turn>")
SYSTEM, USER, ASSISTANT, ROLE, TEXT, CLOSE = range(len(CONTROLS))
OPENS = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = {v: k for k, v in OPENS.items()}
_CONTROL = re.compile(r"(\\|" + "|".join(map(re.escape, CONTROLS)) + ")")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every backslash and every control string; ``unescape`` undoes it."""
    return _CONTROL.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: DataFrame, tokenizer_path: str) -> DataFrame:
    """Encode every turn by itself: ``conv_id, turn, ids, loss_from, loss_to``, a row for each row.

    ``ids`` are little-endian unsigned 32-bit integers, from the turn's opening reserved id to its
    closing one; ``loss_from`` and ``loss_to`` are where the loss mask steps up and down (equal
    where the turn is not learned).  Roles other than system, user and assistant are written out
    after ``### Role:``.

    Null role or text: as empty.  Null conv_id or turn: kept.  Repeated rows: a row each.  Empty
    table: empty result.  Other columns are dropped.  No shuffle; the vocabulary (a fixed file of
    a few megabytes) is broadcast.
    """
    model = turns.sparkSession.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def make():
        bpe = load(model.value)
        first = max(bpe.bytes_of) + 1
        reserved = [(first + i).to_bytes(4, "little") for i in range(len(CONTROLS))]
        encode = lambda text: b"".join(bpe.encode(escape(text), plain=True))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, start, stop = [], [], []
            for role, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                content = encode(text)
                if role in OPENS:
                    head = reserved[OPENS[role]]
                else:
                    head = reserved[ROLE] + encode(role) + reserved[TEXT]
                ids.append(head + content + reserved[CLOSE])
                start.append(len(head) // 4)
                stop.append((len(head) + len(content) * (role == "assistant")) // 4)
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(start, pa.int64()), pa.array(stop, pa.int64())],
                ["conv_id", "turn", "ids", "loss_from", "loss_to"],
            )

        return step

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return map_batches(rows, make, "conv_id long, turn long, ids binary, loss_from long, loss_to long", keeps=True)


class Reader:
    """Reads a conversation back from its ids and mask, turn by turn as they come."""

    def __init__(self, bpe):
        self.bpe, self.first = bpe, max(bpe.bytes_of) + 1
        self.turns, self.loss_chars, self.chars = 0, 0, 0
        self.all, self.learned = hashlib.sha256(), hashlib.sha256()

    def text(self, ids: np.ndarray) -> str:
        return self.bpe.decode(ids.tobytes()).decode("utf-8", "replace")

    def feed(self, ids: np.ndarray, mask: np.ndarray) -> None:
        """Whole turns: what stands between reserved ids is content."""
        marks = np.flatnonzero(ids >= self.first)
        kinds = (ids[marks] - self.first).tolist()
        at = 0
        while at < len(marks):
            kind, role = kinds[at], NAMES.get(kinds[at])
            self.chars += len(CONTROLS[kind])
            if kind == ROLE:
                written = self.text(ids[marks[at] + 1 : marks[at + 1]])
                role, at = unescape(written), at + 1
                self.chars += len(written) + len(CONTROLS[TEXT])
            if role is None or kinds[at + 1] != CLOSE:
                raise ValueError(f"not a turn: {kinds[: at + 2]}")
            lo, hi = marks[at] + 1, marks[at + 1]
            written = self.text(ids[lo:hi])
            self.chars += len(written) + len(CONTROLS[CLOSE])
            self.all.update(f"{role}\n{unescape(written)}\n".encode())
            if (learned := mask[lo:hi]).any():
                said = unescape(self.text(ids[lo:hi][learned]))
                self.loss_chars += len(said)
                self.learned.update(said.encode())
            self.turns += 1
            at += 2

    def row(self, conv_id: int | None) -> tuple:
        return conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.learned.hexdigest(), self.chars


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(parts: DataFrame, tokenizer_path: str) -> DataFrame:
    """Assemble the turns of ``format_turns`` into conversations and read them back.

    One row for each conv_id (null: one conversation of its own).  Turns stand in the order of
    turn (nulls first), ties by their ids.  Repeated rows are turns of their own.  Empty table: empty
    result.  The digests need each conversation's turns in order,
    so a conversation is read by one task, but as a stream of sorted rows: memory does not grow
    with it, and the encoding, which is the work, was done before by even shares of rows.
    """
    spark = parts.sparkSession
    model = spark.sparkContext.broadcast(Path(tokenizer_path).read_text(encoding="utf-8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(model.value)
        reader, now, rows = None, None, []
        names = [c.split()[0] for c in DIGEST.split(", ")]
        types = [pa.string() if "string" in c else pa.int64() for c in DIGEST.split(", ")]
        pack = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)
        for batch in batches:
            of, content, ups, downs = (batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            first = 0
            while first < len(of):
                last = first
                while last < len(of) and of[last] == of[first]:
                    last += 1
                if reader is None or of[first] != now:
                    if reader is not None:
                        rows.append(reader.row(now))
                    reader, now = Reader(bpe), of[first]
                ids = np.frombuffer(b"".join(content[first:last]), "<u4")
                base = np.cumsum([0, *(len(x) // 4 for x in content[first:last])])
                steps = np.zeros(len(ids) + 1, np.int32)
                np.add.at(steps, base[:-1] + ups[first:last], 1)
                np.add.at(steps, base[:-1] + downs[first:last], -1)
                reader.feed(ids, np.cumsum(steps[:-1]) > 0)
                first = last
            if len(rows) >= BATCH_ROWS:
                yield pack()
                rows = []
        if reader is not None:
            rows.append(reader.row(now))
        if rows:
            yield pack()

    ordered = parts.repartition(n_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "ids")
    return ordered.mapInArrow(run, DIGEST)


#: Digests of the same format in SQL (DuckDB), where ``turns`` names the rows.
DIGEST_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
    regexp_replace(coalesce(text, ''), '(\\|### System:|### User:|### Assistant:|### Role:|### Text:|</turn>)', '\\\1', 'g') AS written,
    regexp_replace(coalesce(role, ''), '(\\|### System:|### User:|### Assistant:|### Role:|### Text:|</turn>)', '\\\1', 'g') AS written_role
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(written) + 7 + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 9 WHEN 'assistant' THEN 14
    ELSE 18 + length(written_role) END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
