"""Language of a text by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams, most frequent first.  A text's profile is
compared with each language's by its out-of-place distance: for each n-gram of the text how far its
place is from its place in the language's profile, and ``PROFILE`` places where it is not in it.
The language of the least distance is the text's.

N-grams are of one to three letters of a word, which is a run of letters with a space on either side;
letters are lower-cased one by one.  Three code points of 21 bits make one 64-bit number, so n-grams
are counted exactly and without strings.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_batches, table

#: N-grams of a profile, of a language and of a text.
PROFILE = 1000
#: Languages that are learned: those of the most rows, ties by name.  Bounds what is broadcast.
LANGUAGES = 256
#: What is said of texts without letters.
NONE = "und"
#: Code points handled at a time.
BLOCK = 1 << 20
SPACE = 32


@cache
def letters() -> np.ndarray:
    """For each code point its lower-case letter (itself where lower case is not one code point), a space for no letter."""
    out = np.full(0x110000, SPACE, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of a text and how often each occurs, in blocks of BLOCK code points."""
    found, counts, carry = np.empty(0, np.int64), np.empty(0, np.int64), np.array([SPACE], np.int64)
    for at in range(0, max(1, len(text)), BLOCK):
        new = letters()[np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int64)
        if at + BLOCK >= len(text):
            new = np.append(new, SPACE)
        new = new[(new != SPACE) | (np.append(carry[-1], new[:-1]) != SPACE)]
        stream, old = np.concatenate([carry, new]), len(carry)
        gap = stream == SPACE
        parts = [new[new != SPACE]]
        if len(stream) > 1:
            parts.append((stream[:-1] << 21 | stream[1:])[max(0, old - 1) :])
        if len(stream) > 2:
            parts.append((stream[:-2] << 42 | stream[1:-1] << 21 | stream[2:])[max(0, old - 2) :][~gap[1:-1][max(0, old - 2) :]])
        f, c = np.unique(np.concatenate(parts), return_counts=True)
        found, counts = _merged(np.concatenate([found, f]), np.concatenate([counts, c])) if len(found) else (f, c)
        carry = stream[-2:]
    return found, counts


def _merged(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal n-grams made one, with the sum of their counts."""
    distinct, where = np.unique(found, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, where, counts)
    return distinct, total


def ranked(found: np.ndarray, counts: np.ndarray, most: int = PROFILE) -> np.ndarray:
    """The ``most`` most frequent n-grams, most frequent first, ties by the n-gram."""
    if len(found) > most:  # all that the last place may go to
        least = np.partition(counts, len(counts) - most)[len(counts) - most]
        found, counts = found[counts >= least], counts[counts >= least]
    return found[np.argsort(-counts, kind="stable")][:most]


def learned(docs: DataFrame):
    """The rows that a model may learn from: with a language, crc32(doc_id as text) mod 5 not 0."""
    return docs.where("lang is not null and text is not null").where(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 != 0)


def train(docs: DataFrame, most: int = PROFILE, languages: int = LANGUAGES) -> dict[str, np.ndarray]:
    """The profile of each language: its ``most`` most frequent n-grams over all rows that may be learned from.

    Rows with a null text, lang or doc_id are not used.  Repeated rows count each.  Tasks count a batch of rows before anything is shuffled, so a shuffle carries
    distinct n-grams and not texts, and a language of most rows is counted in even shares.  What
    reaches the driver is ``most`` n-grams of ``languages`` languages at most.  No rows: no profile.
    """
    rows = learned(docs).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    names = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    names = [r["lang"] for r in names.collect()]

    def make():
        known = set(names)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            by: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if lang in known:
                    by.setdefault(lang, []).append(grams(text))
            out = {lang: _merged(np.concatenate([f for f, _ in parts]), np.concatenate([c for _, c in parts])) for lang, parts in by.items()}
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([lang for lang, (f, _) in out.items() for _ in range(len(f))], pa.string()),
                    pa.array(np.concatenate([np.empty(0, np.int64), *(f for f, _ in out.values())])),
                    pa.array(np.concatenate([np.empty(0, np.int64), *(c for _, c in out.values())])),
                ],
                ["lang", "gram", "n"],
            )

        return step

    counts = map_batches(rows, make, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).where(F.col("place") <= most).orderBy("lang", "place").collect()
    profiles: dict[str, list[int]] = {lang: [] for lang in sorted(names)}
    for r in best:
        profiles[r["lang"]].append(r["gram"])
    return {lang: np.array(p, np.int64) for lang, p in profiles.items()}


class Ranker:
    """Distances of texts to all profiles at once: for each known n-gram its place in each profile."""

    def __init__(self, profiles: dict[str, np.ndarray], most: int = PROFILE):
        self.names, self.most = list(profiles), most
        self.known = np.unique(np.concatenate([np.empty(0, np.int64), *profiles.values()]))
        self.place = np.full((len(self.known) + 1, len(self.names)), -1, np.int32)  # the last row: not known
        for i, p in enumerate(profiles.values()):
            self.place[np.searchsorted(self.known, p), i] = np.arange(len(p))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """The language of a text, and 1 less its share of the greatest distance there can be."""
        own = ranked(*grams(text or ""), self.most)
        if not len(own) or not self.names:
            return NONE, 0.0
        at = np.minimum(np.searchsorted(self.known, own), max(0, len(self.known) - 1))
        at = np.where(self.known[at] == own, at, len(self.known)) if len(self.known) else np.zeros(len(own), np.int64)
        place = self.place[at]
        off = np.where(place < 0, self.most, np.abs(place - np.arange(len(own), dtype=np.int32)[:, None])).sum(0, dtype=np.int64)
        best = int(off.argmin())
        return self.names[best], float(1 - off[best] / (self.most * len(own)))


def predict(docs: DataFrame, profiles: dict[str, np.ndarray], most: int = PROFILE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row, from its whole text.

    score is 1 less the distance's share of the greatest one, so 1 for a text that is the profile.
    Null texts and texts without a letter: ``und`` with score 0, as all are without profiles.  Of
    languages equally near the first by name.  Null doc_id: held_out is false.  Repeated rows: a row
    each.  Empty table: empty result.  Other columns are dropped.  The profiles are of a bounded
    size and broadcast; no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def make():
        ranker = Ranker(shared.value, most)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            said = [ranker(t) for t in batch.column(2).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([n for n, _ in said], pa.string()), pa.array([s for _, s in said], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"]
            )

        return step

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_batches(rows, make, "doc_id long, held_out boolean, lang_pred string, score double")


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
