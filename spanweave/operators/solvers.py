"""Operators that column expressions can't hold: assignment and tracking (clustering: ``clusters``).

Each runs once for each key (a video) on that key's rows, with numpy, and breaks ties by lowest
index, so results do not depend on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..shipping import ship, tasks
from ..storage import cut, unsent
from .clusters import by_key, cluster, linked_clusters  # noqa: F401  (they are solvers too)
from .intervals import KEYS, apart, merge
from .joins import covered_within, inside


def cheapest_matching(cost: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of a least-cost matching of all rows, or of all columns if they are fewer.

    Rows are added one at a time along the shortest augmenting path under row and column prices.
    """
    cost = np.asarray(cost, float)
    if not cost.size:
        return []
    if cost.shape[0] > cost.shape[1]:
        return sorted((r, c) for c, r in cheapest_matching(cost.T))
    rows, cols = cost.shape
    cheapest = cost.argmin(1).tolist()
    if len(set(cheapest)) == rows:  # each row can have its own cheapest column
        return list(enumerate(cheapest))
    row_price, col_price = np.zeros(rows), np.zeros(cols)
    owner = np.full(cols, -1)
    for new in range(rows):
        dist, came = np.full(cols, np.inf), np.full(cols, -1)
        closed = np.zeros(cols, bool)
        row, at, base = new, -1, 0.0
        while True:
            reach = base + cost[row] - row_price[row] - col_price
            better = ~closed & (reach < dist - 1e-15)
            dist[better], came[better] = reach[better], at
            open_ = np.where(closed, np.inf, dist)
            at = int(open_.argmin())
            base = float(open_[at])
            closed[at] = True
            if owner[at] < 0:
                break
            row = int(owner[at])
        row_price[new] += base
        for c in np.flatnonzero(closed):
            if owner[c] >= 0:
                row_price[owner[c]] += base - dist[c]
            col_price[c] -= base - dist[c]
        while at >= 0:
            back = int(came[at])
            owner[at] = owner[back] if back >= 0 else new
            at = back
    return sorted((int(r), c) for c, r in enumerate(owner) if r >= 0)


def matched(cost: np.ndarray, most: float) -> tuple[list[tuple[int, int]], list[int], list[int]]:
    """A least-cost matching without its pairs dearer than ``most``, and the rows and columns left."""
    cost = np.asarray(cost, float)
    pairs = [(r, c) for r, c in cheapest_matching(cost) if cost[r, c] <= most]
    return pairs, sorted({*range(cost.shape[0])} - {r for r, _ in pairs}), sorted({*range(cost.shape[1] if cost.ndim > 1 else 0)} - {c for _, c in pairs})


def seats(rows: Sequence, columns: Sequence, costs: np.ndarray, most: float = float("inf")) -> list[int]:
    """Places of the edges (row, column, cost) of a matching with as many pairs as can be, at least cost.

    Only given edges are made pairs.  Each connected component is matched by itself, so a table stands for a
    component's rows and columns and not for all; of edges alike in both the cheapest counts.
    """
    root: dict = {}

    def find(x):
        while (p := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(p, p)
        return x

    for r, c in zip(rows, columns, strict=True):
        a, b = find((0, r)), find((1, c))
        if a != b:
            root[max(a, b)] = min(a, b)
    parts: dict = {}
    for i, r in enumerate(rows):
        parts.setdefault(find((0, r)), []).append(i)
    out = []
    for edges in parts.values():
        of_r = {r: n for n, r in enumerate(sorted({rows[i] for i in edges}))}
        of_c = {c: n for n, c in enumerate(sorted({columns[i] for i in edges}))}
        own = costs[edges]
        dear = np.abs(own).max() * (len(of_r) * len(of_c) + 1) + 1
        grid, edge = np.full((len(of_r), len(of_c)), dear), np.full((len(of_r), len(of_c)), -1)
        for i in edges:
            r, c = of_r[rows[i]], of_c[columns[i]]
            if edge[r, c] < 0 or costs[i] < grid[r, c]:
                grid[r, c], edge[r, c] = costs[i], i
        out += [int(edge[r, c]) for r, c in cheapest_matching(grid) if edge[r, c] >= 0 and grid[r, c] <= most]
    return sorted(out)


def assign(costs: DataFrame, keys: Sequence[str], row: str, column: str, cost: str = "cost", most: float = float("inf")) -> DataFrame:
    """Least-cost 1:1 pairs of each key from rows (row, column, cost), as many as can be; pairs not given are not made.

    Keys stream through a task in their order, many in a batch; one key's edges are held at a time.  Rows
    with a null row, column or cost are no edges; of repeated ones the cheapest counts.
    """
    k = list(keys)
    kind = {f.name: f.dataType.simpleString() for f in costs.schema}
    names = [*k, row, column, cost]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[pa.Table] = []
        for rows in by_key(batches, len(k)):
            found = seats(rows.column(len(k)).to_pylist(), rows.column(len(k) + 1).to_pylist(), rows.column(len(k) + 2).to_numpy(), most)
            if found:
                done.append(rows.take(found))
            if len(done) >= 256:
                yield from pa.concat_tables(done).combine_chunks().to_batches()
                done = []
        if done:
            yield from pa.concat_tables(done).combine_chunks().to_batches()

    ship(costs.sparkSession)
    schema = ", ".join(f"`{n}` {kind[n]}" for n in names[:-1]) + f", `{cost}` double"
    edges = costs.select(*names[:-1], F.col(cost).cast("double").alias(cost)).where(F.col(row).isNotNull() & F.col(column).isNotNull() & F.col(cost).isNotNull() & ~F.isnan(cost))
    dealt = edges.repartition(tasks(costs.sparkSession), *k).sortWithinPartitions(*k, row, column) if k else edges.coalesce(1).sortWithinPartitions(row, column)
    return dealt.mapInArrow(solve, schema)


INELIGIBLE = 1000.0
OFF_SCREEN = "F000"


def speaker_scores(visible: DataFrame, samples: DataFrame, turns: DataFrame, keys: Sequence[str] = KEYS, penalty=0.5) -> DataFrame:
    """Score and coverage of each speaker with each face.

    ``visible``: face, start, end; ``samples``: face, t, p; ``turns``: speaker, start, end.  The
    score is the mean probability inside the speaker's turns less ``penalty`` times the mean outside;
    coverage is the share of the speaker's speech with the face in view.
    """
    k = list(keys)
    own = merge(turns.where("end > start"), [*k, "speaker"])
    speech = own.groupBy(*k, "speaker").agg(F.sum(F.col("end") - F.col("start")).alias("speech"))
    names = speech.select(*k, "speaker")
    # Spans and samples meet each speaker once, not each of its turns; either side is merged, so shared
    # lengths add up without being counted twice.
    shown = merge(visible, [*k, "face"]).join(names, k)
    seen = covered_within(shown, own, [*k, "speaker"], "__c").groupBy(*k, "face", "speaker").agg(F.sum("__c").alias("seen"))
    every = samples.groupBy(*k, "face").agg(F.count("p").alias("n"), F.sum("p").alias("total"))
    hit = inside(samples.join(names, k), own, [*k, "speaker"]).groupBy(*k, "face", "speaker").agg(F.count("p").alias("n_in"), F.sum("p").alias("total_in"))
    found = visible.select(*k, "face").distinct().join(speech, k).join(seen, [*k, "face", "speaker"], "left").join(hit, [*k, "face", "speaker"], "left").join(every, [*k, "face"], "left")
    outside = F.col("n") - F.coalesce("n_in", F.lit(0))
    mean_out = F.when(outside > 0, (F.col("total") - F.coalesce("total_in", F.lit(0.0))) / outside).otherwise(0.0)
    within = F.when(F.col("n_in") > 0, F.col("total_in") / F.col("n_in"))
    return found.select(*k, "face", "speaker", (within - penalty * mean_out).alias("score"), (F.coalesce("seen", F.lit(0)) / F.col("speech")).alias("coverage"))


def assign_speakers(scores: DataFrame, speakers: DataFrame, keys: Sequence[str] = KEYS, least_score=0.05, least_margin=0.05, least_coverage=0.25) -> DataFrame:
    """Each speaker's face, with score, margin, candidate, and whether it is ambiguous or merged.

    Faces and speakers are matched one to one by highest total score among eligible pairs.  A speaker
    left over shares its best face if that scores enough; else it is off screen.  A speaker's faces
    are gathered in one list, of no more than the video has; ``scores`` are written as a table
    first, as they are few and read twice.
    """
    k = list(keys)
    scores = unsent(cut(scores))
    fit = F.coalesce((F.col("coverage") >= least_coverage) & F.col("score").isNotNull(), F.lit(False))
    costs = scores.select(*k, "speaker", "face", F.when(fit, -F.col("score")).otherwise(INELIGIBLE).alias("cost"))
    seats = assign(costs, k, "speaker", "face").where(F.col("cost") < INELIGIBLE).select(*k, "speaker", F.col("face").alias("seat"))
    own = F.when(fit, F.struct((-F.col("score")).alias("less"), "face", "score", "coverage"))
    each = scores.groupBy(*k, "speaker").agg(F.array_sort(F.collect_list(own)).alias("faces"))
    both = speakers.select(*k, "speaker").distinct().join(each, [*k, "speaker"], "left").join(seats, [*k, "speaker"], "left")
    best = F.get("faces", F.lit(0))
    both = both.withColumn("__seat", F.get(F.filter("faces", lambda f: f["face"] == F.col("seat")), F.lit(0)))
    both = both.withColumn("__one", F.coalesce("__seat", best)).withColumn("score", F.col("__one.score"))
    # Of rivals that score alike the one of the greater id.
    rivals = F.filter("faces", lambda f: f["face"] != F.col("__one.face"))
    both = both.withColumn("__rival", F.array_max(F.transform(rivals, lambda f: F.struct(f["score"].alias("score"), f["face"].alias("face")))))
    on, face, rival = F.coalesce(F.col("score") >= least_score, F.lit(False)), F.col("__one.face"), F.col("__rival.face")
    merged = on & F.col("seat").isNull()
    margin = F.col("score") - F.coalesce("__rival.score", F.lit(0.0))
    close = margin < least_margin
    # The texts of the reasons.
    reason = (
        F.when(F.col("faces").isNull(), "no faces were tracked in this video")
        .when(face.isNull(), "no face was on screen for enough of this speaker's speech")
        .when(~on, F.format_string(f"best face %s scored %.3f, below the {least_score:.3f} floor; treated as off-screen", face, "score"))
        .when(merged, F.format_string("%s scored %.3f; shared with a higher-scoring speaker, so this cluster is treated as a split of the same person", face, "score"))
        .when(close & rival.isNotNull(), F.format_string(f"%s scored %.3f against %s at %.3f; margin below {least_margin:.3f}", face, "score", rival, F.col("__rival.score")))
        .otherwise(F.format_string("%s scored %.3f over coverage %.2f", face, "score", F.col("__one.coverage")))
    )
    return both.select(
        *k,
        "speaker",
        F.when(on, face).otherwise(OFF_SCREEN).alias("face"),
        face.alias("candidate"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
        F.when(on | F.col("seat").isNotNull(), margin).otherwise(0.0).alias("margin"),
        F.coalesce("__one.coverage", F.lit(0.0)).alias("coverage"),
        (on & close).alias("ambiguous"),
        merged.alias("merged"),
        reason.alias("reason"),
    )


def assignment_summary(assignments: DataFrame, faces: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """How each video's voices were matched: counts, and least and mean score of those on screen.

    ``faces``: face; those that no voice was matched to are unclaimed.
    """
    k = list(keys)
    on = F.col("face") != OFF_SCREEN
    counts = assignments.groupBy(*k).agg(
        F.count("*").alias("speakers"), F.count_if(on).alias("assigned"), F.count_if(~on).alias("offscreen"), F.count_if("ambiguous").alias("ambiguous"), F.count_if("merged").alias("merged"),
        F.round(F.coalesce(F.min(F.when(on, F.col("score"))), F.lit(0.0)), 4).alias("least_score"), F.round(F.coalesce(F.avg(F.when(on, F.col("score"))), F.lit(0.0)), 4).alias("mean_score"),
    )
    alone = faces.select(*k, "face").distinct().join(assignments.select(*k, "face"), [*k, "face"], "left_anti").groupBy(*k).agg(F.count("*").alias("unclaimed"))
    return counts.join(alone, k, "left").na.fill(0, ["unclaimed"])


def identities(clusters: DataFrame, tracks: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Clusters numbered ``F001`` on, most screen time first, then first seen."""
    k = list(keys)
    per = clusters.join(tracks, [*k, "track_id"]).groupBy(*k, "cluster").agg(
        F.sort_array(F.collect_list("track_id")).alias("track_ids"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.sum("span").alias("screen_time")
    )
    order = W.partitionBy(*k).orderBy(F.desc("screen_time"), "first_seen", "cluster")
    return per.withColumn("face_id", F.format_string("F%03d", F.row_number().over(order))).drop("cluster")


class Motion:
    """Constant-velocity Kalman filters of many boxes at once: centre, aspect and height.

    The four coordinates do not mix, so each is a value with its speed and their variances: arrays of
    one row for each box.
    """

    def __init__(self):
        self.value, self.speed, self.var, self.cov, self.speed_var = (np.empty((0, 4)) for _ in range(5))

    @staticmethod
    def measure(boxes: np.ndarray) -> np.ndarray:
        x, y, w, h = boxes.T
        h = np.maximum(h, 1e-6)
        return np.stack([x + w / 2, y + h / 2, w / h, h], axis=1)

    @staticmethod
    def noise(height: np.ndarray, place: float, speed: float, aspect: float, aspect_speed: float) -> tuple[np.ndarray, np.ndarray]:
        """Variances of places and speeds, in proportion to the height but for the aspect."""
        p, s = (np.repeat((height * f)[:, None], 4, axis=1) for f in (place, speed))
        p[:, 2], s[:, 2] = aspect, aspect_speed
        return p**2, s**2

    def begin(self, boxes: np.ndarray) -> None:
        z = self.measure(boxes)
        var, speed_var = self.noise(z[:, 3], 1 / 10, 1 / 16, 2e-2, 1e-4)
        for name, rows in (("value", z), ("speed", np.zeros_like(z)), ("var", var), ("cov", np.zeros_like(z)), ("speed_var", speed_var)):
            setattr(self, name, np.concatenate([getattr(self, name), rows]))

    def ahead(self) -> None:
        var, speed_var = self.noise(self.value[:, 3], 1 / 20, 1 / 160, 1e-2, 1e-5)
        self.value = self.value + self.speed
        self.var = self.var + 2 * self.cov + self.speed_var + var
        self.cov = self.cov + self.speed_var
        self.speed_var = self.speed_var + speed_var

    def correct(self, at: list[int], boxes: np.ndarray) -> None:
        noise, _ = self.noise(self.value[at, 3], 1 / 20, 0, 1e-2, 0)
        total = self.var[at] + noise
        gain, speed_gain = self.var[at] / total, self.cov[at] / total
        off = self.measure(boxes) - self.value[at]
        self.value[at] += gain * off
        self.speed[at] += speed_gain * off
        self.speed_var[at] -= speed_gain * self.cov[at]
        self.var[at], self.cov[at] = self.var[at] - gain * self.var[at], self.cov[at] - gain * self.cov[at]

    def keep(self, which: np.ndarray) -> None:
        for name in ("value", "speed", "var", "cov", "speed_var"):
            setattr(self, name, getattr(self, name)[which])

    @property
    def boxes(self) -> np.ndarray:
        x, y, a, h = self.value.T
        return np.stack([x - a * h / 2, y - h / 2, a * h, h], axis=1)


def iou_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - IoU of each box of ``a`` with each of ``b``."""
    a, b = np.reshape(a, (-1, 1, 4)), np.reshape(b, (1, -1, 4))
    side = np.minimum(a[..., :2] + a[..., 2:], b[..., :2] + b[..., 2:]) - np.maximum(a[..., :2], b[..., :2])
    shared = np.clip(side, 0, None).prod(-1)
    union = a[..., 2:].prod(-1) + b[..., 2:].prod(-1) - shared
    return 1 - np.divide(shared, union, out=np.zeros_like(shared), where=union > 0)


class Tracker:
    """Joins detections to tracks frame by frame: confident ones first, then the held-back ones.

    The second pass can only continue tracks that are still followed; a lost track comes back in the
    first pass alone, and ends when unseen for more than ``patience`` frames.
    """

    def __init__(self, confident=0.5, floor=0.1, birth=0.6, near=0.8, near_second=0.5, patience=30):
        self.confident, self.floor, self.birth = confident, floor, birth
        self.near, self.near_second, self.patience = near, near_second, patience
        self.motion = Motion()
        self.ids, self.missed, self.lost = np.empty(0, int), np.empty(0, int), np.empty(0, bool)
        self.born = 0

    def frame(self, boxes: np.ndarray, scores: np.ndarray) -> list[int]:
        """The track of each detection, 0 for none."""
        out = [0] * len(scores)
        if len(self.ids):
            self.motion.ahead()
            self.missed += 1
        scores = np.asarray(scores, float)
        high = np.flatnonzero(scores > self.confident).tolist()
        low = np.flatnonzero((scores > self.floor) & (scores <= self.confident)).tolist()

        def join(tracks: list[int], those: list[int], most: float) -> tuple[list[int], list[int]]:
            if not tracks or not those:
                return tracks, those
            pairs, rest_t, rest_d = matched(iou_distance(self.motion.boxes[tracks], boxes[those]), most)
            if pairs:
                at, of = [tracks[r] for r, _ in pairs], [those[c] for _, c in pairs]
                self.motion.correct(at, boxes[of])
                self.missed[at], self.lost[at] = 0, False
                for t, i in zip(at, of, strict=True):
                    out[i] = int(self.ids[t])
            return [tracks[r] for r in rest_t], [those[c] for c in rest_d]

        rest, unused = join(list(range(len(self.ids))), high, self.near)
        followed, _ = join([t for t in rest if not self.lost[t]], low, self.near_second)
        self.lost[followed] = True
        if len(gone := np.flatnonzero(self.missed > self.patience)):
            stay = np.delete(np.arange(len(self.ids)), gone)
            self.motion.keep(stay)
            self.ids, self.missed, self.lost = self.ids[stay], self.missed[stay], self.lost[stay]
        new = [i for i in unused if scores[i] >= self.birth]
        if new:
            self.motion.begin(boxes[new])
            fresh = np.arange(self.born + 1, self.born + 1 + len(new))
            self.born += len(new)
            self.ids, self.missed, self.lost = np.r_[self.ids, fresh], np.r_[self.missed, np.zeros(len(new), int)], np.r_[self.lost, np.zeros(len(new), bool)]
            for i, t in zip(new, fresh.tolist(), strict=True):
                out[i] = t
        return out


#: Rows of a video that one task tracks without looking for places to cut it.
WHOLE = 20_000
#: Frames of a bucket in which a long video's frames are counted.
BUCKET = 1 << 14


def pieces(rows: DataFrame, keys: Sequence[str], looked: DataFrame, floor: float, patience: int) -> DataFrame:
    """``frame, piece, gap`` of each frame that has a detection over ``floor``: the stretches of a key that
    can be tracked by themselves, and how many frames without one lie before the frame.

    A tracker that saw more than ``patience`` such frames in a row follows nothing any more, so what comes
    next is tracked as from the beginning.  ``looked`` (keys, frame): all frames that were looked at.
    Frames are counted within buckets, and the buckets' few rows give what came before, so that a video is
    not one task.
    """
    k = list(keys)
    usable = F.coalesce((F.col("score") > floor) & ~F.isnan("score"), F.lit(False))
    seen = rows.select(*k, "frame", usable.alias("on"))
    every = apart(seen).unionByName(apart(looked.select(*k, "frame", F.lit(False).alias("on")))).groupBy(*k, "frame").agg(F.max("on").alias("on"))
    every = every.withColumn("bucket", F.floor(F.col("frame") / BUCKET))
    inside = W.partitionBy(*k, "bucket").orderBy("frame")
    place = F.row_number().over(inside)
    every = every.withColumn("n", place).withColumn("last", F.max(F.when(F.col("on"), F.col("n"))).over(inside.rowsBetween(W.unboundedPreceding, -1)))
    before = W.partitionBy(*k).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    per = every.groupBy(*k, "bucket").agg(F.max("n").alias("n"), F.max(F.when(F.col("on"), F.col("n"))).alias("last"))
    per = per.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    per = per.select(*k, "bucket", "base", F.max(F.col("base") + F.col("last")).over(before).alias("earlier"))
    found = every.where("on").join(per, [*k, "bucket"])
    last = F.coalesce(F.col("base") + F.col("last"), F.col("earlier"))
    gap = F.col("base") + F.col("n") - last - 1
    found = found.select(*k, "bucket", "frame", F.coalesce(gap, F.lit(0)).alias("gap"), F.coalesce(gap > patience, F.lit(True)).cast("int").alias("cut"))
    found = found.withColumn("here", F.sum("cut").over(inside))
    cuts = found.groupBy(*k, "bucket").agg(F.sum("cut").alias("cuts"))
    cuts = cuts.select(*k, "bucket", F.coalesce(F.sum("cuts").over(before), F.lit(0)).alias("there"))
    return found.join(cuts, [*k, "bucket"]).select(*k, "frame", (F.col("here") + F.col("there")).alias("piece"), F.col("gap").cast("long").alias("gap"))


def track(detections: DataFrame, keys: Sequence[str] = KEYS, frames: DataFrame | None = None, **limits) -> DataFrame:
    """Detections (``frame, x, y, w, h, score``) with their ``track_id``; those of no track are dropped.

    ``frames`` (keys, ``frame``): all that were looked at, so that tracks age in those without faces
    too; without it only frames with detections count.  A video of more than ``WHOLE`` detections is cut
    where the tracker follows nothing (``pieces``), and each stretch is a group of its own; its tracks
    are numbered on from those of the stretches before.  A stretch without such a gap is one task.
    """
    k = list(keys)
    cols = [*k, "frame", "x", "y", "w", "h", "score"]
    kind = {f.name: f.dataType.simpleString() for f in detections.schema}

    def solve(rows: pa.Table) -> pa.Table:
        frame, x, y, w, h, score = (rows.column(c).to_numpy() for c in cols[len(k) :])
        gap = rows.column("gap").to_numpy() if "gap" in rows.column_names else None
        order = np.lexsort((h, w, y, x, -score, frame))
        frame, score, box = frame[order], score[order], np.stack([x, y, w, h], axis=1)[order].astype(float)
        tracker = Tracker(**limits)
        ids = np.zeros(len(order), int)
        bounds = [0, *(np.flatnonzero(frame[1:] != frame[:-1]) + 1).tolist(), len(order)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if gap is not None and a:
                for _ in range(int(gap[order[a]])):
                    tracker.frame(box[:0], score[:0])
            if np.isnan(score[a:b]).any():  # a frame without faces
                tracker.frame(box[:0], score[:0])
            else:
                ids[a:b] = tracker.frame(box[a:b], score[a:b])
        kept = np.flatnonzero(ids)
        out = rows.take(pa.array(order[kept])).append_column("track_id", pa.array(ids[kept], pa.int32()))
        return out.drop_columns(["gap"]) if gap is not None else out

    def stream(n: int):
        """Groups by their first ``n`` columns, many in a batch; one is held at a time."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            done: list[pa.Table] = []
            for rows in by_key(batches, n):
                done.append(solve(rows.combine_chunks()))
                if len(done) >= 256:
                    yield from pa.concat_tables(done).combine_chunks().to_batches()
                    done = []
            if done:
                yield from pa.concat_tables(done).combine_chunks().to_batches()

        return run

    def grouped(some: DataFrame, by: list[str], schema: str) -> DataFrame:
        # A row is much more work than its bytes show, so tasks are dealt by number.
        width = tasks(some.sparkSession)
        return some.repartition(width, *by).sortWithinPartitions(*by).mapInArrow(stream(len(by)), schema)

    ship(detections.sparkSession)
    rows = detections.select(*cols)
    schema = ", ".join(f"`{n}` {kind[n]}" for n in cols)

    def whole(rows: DataFrame, frames: DataFrame | None) -> DataFrame:
        if frames is not None:
            empty = frames.select(*k, "frame").distinct().join(rows.select(*k, "frame"), [*k, "frame"], "left_anti")
            rows = apart(rows).unionByName(apart(empty), allowMissingColumns=True)
        return grouped(rows.select(*cols), k, schema + ", track_id int")

    long = rows.groupBy(*k).count().where(F.col("count") > WHOLE).drop("count")
    if long.isEmpty():
        return whole(rows, frames)
    long = cut(long)
    rest = whole(rows.join(long, k, "left_anti"), None if frames is None else frames.join(long, k, "left_anti"))
    rows = rows.join(long, k, "left_semi")
    looked = rows.select(*k, "frame") if frames is None else frames.join(long, k, "left_semi").select(*k, "frame")
    defaults = Tracker(**limits)
    places = pieces(rows, k, looked, defaults.floor, defaults.patience)
    parts = rows.join(places, [*k, "frame"]).select(*k, "piece", *cols[len(k) :], "gap")
    schema = ", ".join(f"`{n}` {kind[n]}" for n in k) + ", piece long, " + ", ".join(f"`{n}` {kind[n]}" for n in cols[len(k) :])
    found = cut(grouped(parts, [*k, "piece"], schema + ", track_id int"))
    before = W.partitionBy(*k).orderBy("piece").rowsBetween(W.unboundedPreceding, -1)
    born = found.groupBy(*k, "piece").agg(F.max("track_id").alias("born"))
    born = born.select(*k, "piece", F.coalesce(F.sum("born").over(before), F.lit(0)).cast("int").alias("earlier"))
    found = found.join(born, [*k, "piece"]).select(*cols, (F.col("track_id") + F.col("earlier")).alias("track_id"))
    return apart(rest).unionByName(apart(found))


def track_quality(tracked: DataFrame, fps: float, keys: Sequence[str] = KEYS) -> DataFrame:
    """Frames, span, mean score and size, and motion (mean step over mean height) of each track."""
    k = [*keys, "track_id"]
    order = W.partitionBy(*k).orderBy("frame")
    cx, cy = F.col("x") + F.col("w") / 2, F.col("y") + F.col("h") / 2
    step = F.sqrt(F.pow(cx - F.lag(cx).over(order), 2) + F.pow(cy - F.lag(cy).over(order), 2))
    return tracked.withColumn("__step", step).groupBy(*k).agg(
        F.count("*").alias("frames"),
        ((F.max("frame") - F.min("frame") + 1) / fps).alias("span"),
        F.avg("score").alias("mean_score"),
        F.avg("w").alias("mean_width"),
        F.avg("h").alias("mean_height"),
        F.coalesce(F.avg("__step") / F.avg("h"), F.lit(0.0)).alias("motion"),
    )


def rejection(quality: DataFrame, frames=3, span=0.3, score=0.6, height=16) -> DataFrame:
    """Tracks with the first ``reason`` to drop them, null for those kept."""
    # The texts of the reasons.
    reason = (
        F.when(F.col("frames") < frames, F.format_string("only %d detections", F.col("frames").cast("long")))
        .when(F.col("span") < span, F.format_string("visible for %.2fs", "span"))
        .when(F.col("mean_score") < score, F.format_string("mean detection score %.2f", "mean_score"))
        .when(F.col("mean_height") < height, F.format_string("face only %.0fpx tall", "mean_height"))
    )
    return quality.withColumn("reason", reason)
