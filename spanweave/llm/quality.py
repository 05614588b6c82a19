"""Quality classifier: Naive Bayes support vectors.

A text is the set of its n-grams (indicators, not counts).  Each indicator is scaled by the log
ratio of its smoothed shares in the two classes, and a linear hinge-loss model is fitted on the
scaled indicators by dual coordinate descent.  A sigmoid fitted on margins of rows that the
margin's model has not seen turns the margin into a score.

Two families of n-grams: character n-grams of the lower-cased text, and n-grams of *word shapes*
(case, letters or marks, how the word ends, whether it repeats the word before), which hold what
does not depend on the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, map_batches, table, text_of

#: Indicator slots of each family.
CHAR_BITS, SHAPE_BITS = 17, 16
SLOTS = (1 << CHAR_BITS) + (1 << SHAPE_BITS)
CHAR_N = (3,)
SHAPE_N = (1, 2, 3)
#: Labelled rows to fit on, at most so many of each class: those with the smallest hashes of
#: doc_id.  The bound keeps the fit in one task whatever the size of the corpus.
FIT_ROWS_PER_CLASS = 2_000
#: Their indicators at most, of each class: what the one task that fits holds.  Of texts like the tables'
#: 2,000 have about a third of it; of very long texts fewer than 2,000 are used.
FIT_INDICATORS_PER_CLASS = 10_000_000
#: Code points of a text turned into n-grams at a time, or more where no white space stands between;
#: n-grams across a cut are kept, so the indicators do not depend on it.
BLOCK = 1 << 18
SPACE = re.compile(r"\s")
THRESHOLD = 0.3


MIX = np.uint32(0x9E3779B1)


def _slots(h: np.ndarray, bits: int) -> np.ndarray:
    return (h ^ (h >> np.uint32(15))) * MIX >> np.uint32(32 - bits)


def _once(found: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each value of ``found`` once; ``seen`` is scratch space."""
    order = np.arange(len(found), dtype=np.int32)
    seen[found] = order
    return found[seen[found] == order]


STOPS, MARKS = ".,;:'\"-?", ".,;:'\"-?!#$%&()*+/<=>@[\\]^_`{|}~"


class Shapes(dict):
    """A small number for each word's shape: case, ending, marks; remembers ``KEPT`` words."""

    KEPT = 200_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.KEPT:
            self.clear()
        bare = word.strip(MARKS)
        case = 0 if word.islower() else 1 if word.isupper() else 2 if bare.istitle() else 3
        tail = 0 if word[-1] not in MARKS else 1 if word[-1] in STOPS else 2
        self[word] = shape = 1 + case + 4 * tail + 32 * (not bare) + 64 * min(3, len(word) - len(bare))
        return shape

    def of(self, words: list[str], before: str | None = None) -> np.ndarray:
        """Shapes of a row of words that follow ``before``, with a mark on words that repeat the one before."""
        shape = np.fromiter(map(self.__getitem__, words), np.uint32, len(words))
        shape += np.fromiter(map(eq, words, [before, *words[:-1]]), np.bool_, len(words)) * np.uint32(16)
        return shape


class Extractor:
    """Turns texts into sets of indicator slots; holds scratch space of a fixed size."""

    def __init__(self):
        self.seen, self.shapes = np.zeros(SLOTS, np.int32), Shapes()

    def __call__(self, text: str) -> np.ndarray:
        if len(text) <= BLOCK:
            return self.block(self.codes(text), self.shapes.of(text.split()))
        found = np.zeros(SLOTS, bool)
        codes, shapes, word = np.empty(0, np.uint32), np.empty(0, np.uint32), None
        for part in pieces(text):
            words = part.split()
            codes, shapes = np.r_[codes[-2:], self.codes(part)], np.r_[shapes[-2:], self.shapes.of(words, word)]
            found[self.block(codes, shapes)] = True
            word = words[-1] if words else word
        return np.flatnonzero(found).astype(np.uint32)

    @staticmethod
    def codes(text: str) -> np.ndarray:
        return np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8).astype(np.uint32)

    def block(self, codes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        found = []
        for values, sizes, base, bits, first in ((codes, CHAR_N, 257, CHAR_BITS, 0), (shapes, SHAPE_N, 1021, SHAPE_BITS, 1 << CHAR_BITS)):
            for n in sizes:
                if len(values) >= n:
                    h = values[: len(values) - n + 1] + np.uint32(n << 24)
                    for i in range(1, n):
                        h = h * np.uint32(base) + values[i : len(values) - n + 1 + i]
                    found.append(_slots(h, bits) + np.uint32(first))
        return _once(np.concatenate(found), self.seen) if found else np.empty(0, np.uint32)


def pieces(text: str) -> Iterator[str]:
    """The text in pieces of about BLOCK code points that each begin with white space, but for the first."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > BLOCK:
            end = max(text.rfind(" ", at + 1, at + BLOCK), text.rfind("\n", at + 1, at + BLOCK))
            if end < 0:
                cut = SPACE.search(text, at + BLOCK)
                end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def fit(rows: Iterable[tuple[np.ndarray, int]], cost: float = 1.0, rounds: int = 12, seed: int = 0) -> dict[str, np.ndarray | float]:
    """Weights, bias and sigmoid of an NB-SVM fitted on (indicator slots, label) rows.

    With one class only, or no rows, the model is the constant of the smoothed share of label 1.
    """
    sets, y = [], []
    for slots, label in rows:
        sets.append(slots)
        y.append(1 if label else -1)
    y = np.array(y, np.int64)
    share = ((y > 0).sum() + 1) / (len(y) + 2)
    constant = {"w": np.zeros(SLOTS), "bias": 0.0, "slope": 0.0, "offset": float(np.log(share / (1 - share)))}
    if len(set(y.tolist())) < 2:
        return constant
    folds = np.arange(len(y)) % 3
    rng = np.random.default_rng(seed)
    folds = folds[rng.permutation(len(y))]
    margins = np.zeros(len(y))
    for k in range(3):
        inside = np.flatnonzero(folds != k)
        if len(set(y[inside].tolist())) < 2:
            return constant
        w, bias = _svm([sets[i] for i in inside], y[inside], cost, rounds, rng)
        for i in np.flatnonzero(folds == k):
            margins[i] = margin(w, bias, sets[i])
    slope, offset = _sigmoid(margins, y)
    w, bias = _svm(sets, y, cost, rounds, rng)
    return {"w": w, "bias": bias, "slope": slope, "offset": offset}


def score(model: dict, slots: np.ndarray) -> float:
    """Chance of label 1, from 0 to 1."""
    z = model["slope"] * margin(model["w"], model["bias"], slots) + model["offset"]
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def margin(w: np.ndarray, bias: float, slots: np.ndarray) -> float:
    return float(w[slots].sum() / np.sqrt(max(1, len(slots))) + bias)


def _svm(sets: list[np.ndarray], y: np.ndarray, cost: float, rounds: int, rng) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss on indicators scaled by log-count ratios."""
    counts = {s: np.ones(SLOTS) for s in (1, -1)}
    for x, s in zip(sets, y.tolist(), strict=True):
        counts[s][x] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[-1] / counts[-1].sum())
    scaled = [ratio[x] / np.sqrt(max(1, len(x))) for x in sets]
    # A row is divided by the root of its number of indicators, so long texts do not outweigh short ones.
    square = np.array([r @ r + 1 for r in scaled])
    weight = {1: cost, -1: cost * (y > 0).sum() / (y < 0).sum()}
    alpha, v, bias = np.zeros(len(y)), np.zeros(SLOTS), 0.0
    for _ in range(rounds):
        for i in rng.permutation(len(y)):
            s = y[i]
            gradient = s * (v[sets[i]] @ scaled[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), weight[int(s)])
            if new != alpha[i]:
                step = (new - alpha[i]) * s
                v[sets[i]] += step * scaled[i]
                bias += step
                alpha[i] = new
    return v * ratio, bias


def _sigmoid(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the sigmoid by Newton steps on smoothed targets, classes weighing alike."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    each = np.where(y > 0, 0.5 / n1, 0.5 / n0)
    slope, offset = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margin + offset, -30, 30)))
        g = each * (p - target)
        h = each * p * (1 - p)
        a, b, c = (h * margin**2).sum() + 1e-9, (h * margin).sum(), h.sum() + 1e-9
        g1, g0 = (g * margin).sum(), g.sum()
        det = a * c - b * b
        slope, offset = slope - (c * g1 - b * g0) / det, offset - (a * g0 - b * g1) / det
    return float(slope), float(offset)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = FIT_ROWS_PER_CLASS, indicators: int = FIT_INDICATORS_PER_CLASS) -> dict:
    """Fit on labelled rows whose crc32(doc_id as text) mod 5 is not 0, ``per_class`` of each class at most,
    and of these, by the hash of their ids, as many as have ``indicators`` together (one at least).

    The chosen labels are a bounded number of rows and broadcast; indicators are made where the
    texts are, and one task fits the model, which is all that reaches the driver.  Rows with a
    null id or label are not used; a doc_id with both labels counts with each.  Of the rows of
    ``docs`` that share a doc_id one text is used, that of the smallest hash, so the fit is bounded
    however often ids repeat.
    """
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col(label) != 0).cast("int").alias("y"))
    usable = usable.where("doc_id is not null and y is not null").where(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = usable.where("y = 0").orderBy(by_hash).limit(per_class).union(usable.where("y = 1").orderBy(by_hash).limit(per_class))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).join(F.broadcast(chosen.distinct()), "doc_id")
    rows = rows.select("doc_id", "y", F.xxhash64("text").alias("h"), "text")

    def make():
        extract = Extractor()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [extract(t).astype(np.int32) for t in batch.column(3).to_pylist()]
            return pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sets, pa.list_(pa.int32()))], ["doc_id", "y", "h", "slots"])

        return step

    def solve(batches):
        found = [(i, y, x.values.to_numpy()) for b in batches for i, y, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True)]
        found.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), r[0], r[1], r[2].tobytes()))
        m = fit((x, y) for _, y, x in found)
        numbers = [[float(m[k])] for k in ("bias", "slope", "offset")]
        yield pa.RecordBatch.from_arrays([pa.array([m["w"].astype("<f8").tobytes()], pa.binary()), *map(pa.array, numbers)], ["w", "bias", "slope", "offset"])

    sets = map_batches(rows, make, "doc_id long, y int, h long, slots array<int>").groupBy("doc_id", "y").agg(F.min_by("slots", "h").alias("slots"))
    sets = cut(sets)
    held = F.sum(F.size("slots")).over(W.partitionBy("y").orderBy(*by_hash).rowsBetween(W.unboundedPreceding, -1))
    used = sets.select("doc_id", "y", (F.coalesce(held, F.lit(0)) + F.size("slots")).alias("held"), held.isNull().alias("first"))
    # At most per_class rows of each class.
    sets = sets.join(F.broadcast(used.where(f"first or held <= {indicators}").select("doc_id", "y")), ["doc_id", "y"]).select("doc_id", "y", "slots")
    row = sets.repartition(1).mapInArrow(solve, "w binary, bias double, slope double, offset double").first()
    if row is None:  # an empty table may leave no task
        return fit([])
    return {"w": np.frombuffer(row["w"], "<f8"), "bias": row["bias"], "slope": row["slope"], "offset": row["offset"]}


def score_documents(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row, from its whole text.

    Null text: as empty; its score is that of the model's constant.  Null doc_id: held_out is
    false.  Repeated rows: a row each.  Empty table: empty result.  Other columns are dropped.
    The model is of a fixed size and broadcast; no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        extract, m = Extractor(), shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            p = [score(m, extract(t)) for t in batch.column(2).to_pylist()]
            said = pa.array([int(x >= THRESHOLD) for x in p], pa.int32())
            return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p, pa.float64()), said], ["doc_id", "held_out", "score", "predicted"])

        return step

    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), text_of().alias("text"))
    return map_batches(rows, make, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of ``docs`` that the model doesn't reject, with all their columns.

    Each row is scored by its whole text alone, however long.  Null text: as empty, with the score of
    the model's constant.  Repeated rows: a row each.  Empty table: empty result.  Columns stay as
    they are, whatever their names; no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def make():
        extract, m = Extractor(), shared.value
        return lambda batch: batch.filter(pa.array([score(m, extract(t or "")) >= THRESHOLD for t in batch.column(at).to_pylist()], pa.bool_()))

    return map_batches(docs, make, docs.schema)


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
