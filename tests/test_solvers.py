"""Tracking, clustering and speaker assignment against independent plain versions, on random input."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanweave.operators import clusters
from spanweave.operators import solvers as L


def plain_matching(cost):
    """Pairs of a least-cost matching of all of the shorter side, by trying each."""
    rows, cols = len(cost), len(cost[0]) if cost else 0
    if not rows or not cols:
        return []
    if rows > cols:
        return [(r, c) for c, r in plain_matching([list(x) for x in zip(*cost, strict=True)])]
    return min(([(r, c) for r, c in enumerate(p)] for p in itertools.permutations(range(cols), rows)), key=lambda pairs: sum(cost[r][c] for r, c in pairs))


# --- tracker


class PlainTrack:
    """A box followed by a Kalman filter of four independent coordinates, each a 2 x 2 problem."""

    def __init__(self, number, box):
        self.number, self.missed, self.lost = number, 0, False
        z = self.measured(box)
        h = z[3]
        place, speed = (h / 10, h / 10, 2e-2, h / 10), (h / 16, h / 16, 1e-4, h / 16)
        self.state = [[z[i], 0.0, place[i] ** 2, 0.0, speed[i] ** 2] for i in range(4)]  # value, speed, variances and covariance

    @staticmethod
    def measured(box):
        x, y, w, h = box
        return x + w / 2, y + h / 2, w / h, h

    def predict(self):
        h = self.state[3][0]
        place, speed = (h / 20, h / 20, 1e-2, h / 20), (h / 160, h / 160, 1e-5, h / 160)
        for i, (v, s, pp, ps, ss) in enumerate(self.state):
            self.state[i] = [v + s, s, pp + 2 * ps + ss + place[i] ** 2, ps + ss, ss + speed[i] ** 2]
        self.missed += 1

    def update(self, box):
        h = self.state[3][0]
        noise = (h / 20, h / 20, 1e-2, h / 20)
        for i, z in enumerate(self.measured(box)):
            v, s, pp, ps, ss = self.state[i]
            total = pp + noise[i] ** 2
            a, b = pp / total, ps / total
            self.state[i] = [v + a * (z - v), s + b * (z - v), pp - a * pp, ps - a * ps, ss - b * ps]
        self.missed, self.lost = 0, False

    def box(self):
        x, y, a, h = (c[0] for c in self.state)
        return x - a * h / 2, y - h / 2, a * h, h


def plain_iou(a, b):
    w = min(a[0] + a[2], b[0] + b[2]) - max(a[0], b[0])
    h = min(a[1] + a[3], b[1] + b[3]) - max(a[1], b[1])
    return w * h / (a[2] * a[3] + b[2] * b[3] - w * h) if w > 0 and h > 0 else 0.0


def plain_track(frames, patience):
    """Track numbers of each frame's (box, score) detections."""
    live, born, out = [], 0, []
    for dets in frames:
        ids = [0] * len(dets)
        for t in live:
            t.predict()

        def join(tracks, which, most, dets=dets, ids=ids):
            cost = [[1 - plain_iou(t.box(), dets[i][0]) for i in which] for t in tracks]
            pairs = [(r, c) for r, c in (plain_matching(cost) if tracks and which else []) if cost[r][c] <= most]
            for r, c in pairs:
                tracks[r].update(dets[which[c]][0])
                ids[which[c]] = tracks[r].number
            return [t for r, t in enumerate(tracks) if r not in {p for p, _ in pairs}], [i for c, i in enumerate(which) if c not in {q for _, q in pairs}]

        rest, unused = join(live, [i for i, (_, s) in enumerate(dets) if s > 0.5], 0.8)
        followed, _ = join([t for t in rest if not t.lost], [i for i, (_, s) in enumerate(dets) if 0.1 < s <= 0.5], 0.5)
        for t in followed:
            t.lost = True
        live = [t for t in live if t.missed <= patience]
        for i in unused:
            if dets[i][1] >= 0.6:
                born += 1
                live.append(PlainTrack(born, dets[i][0]))
                ids[i] = born
        out.append(ids)
    return out


@pytest.mark.parametrize("seed", range(12))
def test_tracker_equals_a_plain_one(seed):
    rng = random.Random(seed)
    faces = [[rng.uniform(0, 400), rng.uniform(0, 300), rng.uniform(-6, 6), rng.uniform(-3, 3), rng.uniform(30, 60)] for _ in range(rng.randint(1, 4))]
    frames = []
    for _ in range(60):
        dets = []
        for f in faces:
            f[0], f[1] = f[0] + f[2], f[1] + f[3]
            if rng.random() < 0.75:
                dets.append(((f[0] + rng.gauss(0, 1.5), f[1] + rng.gauss(0, 1.5), f[4] * rng.uniform(0.9, 1.1), f[4] * 1.2 * rng.uniform(0.9, 1.1)), rng.uniform(0.05, 1)))
        rng.shuffle(dets)
        frames.append(dets)
    tracker = L.Tracker(patience=5)
    found = [list(tracker.frame(np.array([b for b, _ in dets]).reshape(-1, 4), np.array([s for _, s in dets]))) for dets in frames]
    assert found == plain_track(frames, 5) and max(map(max, filter(None, found))) >= len(faces)


def test_tracks_of_a_table_equal_plain_ones(spark):
    rng = random.Random(99)
    rows, expected = [], {}
    for video in ("a", "b", "c"):
        frames = []
        for f in range(25):
            dets = [((50.0 + 100 * k + 2 * f + rng.random(), 40.0 + rng.random(), 40.0, 50.0), round(rng.uniform(0.2, 1), 6)) for k in range(3) if rng.random() < 0.8]
            dets.sort(key=lambda d: (-d[1], d[0]))
            frames.append(dets)
            rows += [(video, f, *b, s) for b, s in dets]
        for f, ids in enumerate(plain_track(frames, 30)):
            for (b, _), i in zip(frames[f], ids, strict=True):
                if i:
                    expected[video, f, b[0]] = i
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "video_id string, frame long, x double, y double, w double, h double, score double").repartition(3)
    every = spark.range(25).select(F.explode(F.array(*[F.lit(v) for v in "abc"])).alias("video_id"), F.col("id").alias("frame"))
    assert {(r.video_id, r.frame, r.x): r.track_id for r in L.track(df, frames=every).collect()} == expected


@pytest.mark.parametrize("looked", [True, False])
def test_long_videos_are_cut_where_nothing_is_followed(spark, monkeypatch, looked):
    """Stretches tracked apart give what the whole gives: gaps of every length around patience, and frames
    whose detections are too weak to count."""
    rng = random.Random(8)
    rows, seen = [], []
    for video in ("a", "b", "c"):
        f = rng.randint(0, 5)
        for _ in range(40):
            for _ in range(rng.randint(1, 6)):
                for face in range(rng.randint(1, 3)):
                    rows.append((video, f, 50.0 + 90 * face + rng.random(), 40.0, 40.0, 50.0, rng.choice([0.7, 0.9, 0.4, 0.62])))
                seen.append((video, f))
                f += 1
            for _ in range(rng.randint(0, 8)):
                seen.append((video, f))
                if rng.random() < 0.5:
                    rows.append((video, f, 50.0, 40.0, 40.0, 50.0, rng.choice([0.1, 0.05])))
                f += rng.choice([1, 1, 7])
    rows += [("d", 3, 1.0, 1.0, 5.0, 5.0, 0.05)]
    df = spark.createDataFrame(rows, "video_id string, frame long, x double, y double, w double, h double, score double").repartition(3)
    frames = spark.createDataFrame(seen, "video_id string, frame long") if looked else None
    key = lambda df: sorted((r.video_id, r.frame, r.x, r.track_id) for r in df.collect())
    whole = key(L.track(df, frames=frames, patience=4))
    monkeypatch.setattr(L, "BUCKET", 16)
    monkeypatch.setattr(L, "WHOLE", 0)
    assert key(L.track(df, frames=frames, patience=4)) == whole
    monkeypatch.setattr(L, "WHOLE", sum(r[0] == "a" for r in rows) - 1)  # some by one way, some by the other
    assert key(L.track(df, frames=frames, patience=4)) == whole
    found = L.pieces(df, ["video_id"], df.select("video_id", "frame") if frames is None else frames, 0.1, 4)
    counts = {r["video_id"]: r["n"] for r in found.groupBy("video_id").agg(F.max("piece").alias("n")).collect()}
    assert "d" not in counts and all(n > (4 if looked else 1) for n in counts.values())


def test_small_videos_are_many_tasks(spark):
    """Rows of few bytes that cost much are dealt by number, not put together by size."""
    boxes = spark.range(200).selectExpr("id div 2 video_id", "id % 2 frame", "10.0D x", "10.0D y", "30.0D w", "40.0D h", "0.9D score")
    found = L.track(boxes).select(F.spark_partition_id().alias("task"), "track_id").collect()
    assert len(found) == 200 and {r.track_id for r in found} == {1} and len({r.task for r in found}) > 4


def test_one_video_is_many_groups(spark, monkeypatch):
    monkeypatch.setattr(L, "WHOLE", 1000)
    boxes = spark.range(40_000).select(F.lit("v").alias("video_id"), (F.col("id") * 2 + F.floor(F.col("id") / 100) * 200).alias("frame"), F.lit(10.0).alias("x"), F.lit(10.0).alias("y"), F.lit(30.0).alias("w"), F.lit(40.0).alias("h"), F.lit(0.9).alias("score"))
    looked = spark.range(200_000).select(F.lit("v").alias("video_id"), F.col("id").alias("frame"))
    tracked = L.track(boxes, frames=looked)
    found = tracked.groupBy("track_id").agg(F.count("*").alias("n"), F.min("frame").alias("first")).orderBy("track_id").collect()
    assert [r.track_id for r in found] == list(range(1, 401)) and {r.n for r in found} == {100} and [r["first"] for r in found] == [400 * i for i in range(400)]


# --- clusters


def plain_clusters(vectors, most=0.45):
    """Average linkage by the means of all distances between members."""
    def cosine(a, b):
        n = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
        return sum(x * y for x, y in zip(a, b, strict=True)) / n if n else 0.0

    groups = [[i] for i in range(len(vectors))]
    while len(groups) > 1:
        best = None
        for a in range(len(groups)):
            for b in range(a + 1, len(groups)):
                mean = sum(1 - cosine(vectors[i], vectors[j]) for i in groups[a] for j in groups[b]) / len(groups[a]) / len(groups[b])
                if best is None or mean < best[0] - 1e-9:
                    best = mean, a, b
        if best[0] > most:
            break
        groups[best[1]] += groups.pop(best[2])
    return sorted(sorted(g) for g in groups)


@pytest.mark.parametrize("seed", range(8))
def test_clusters_equal_plain_ones(seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(3)]
    vectors = [[c + rng.gauss(0, rng.choice([0.2, 0.7])) for c in rng.choice(centres)] for _ in range(rng.randint(1, 18))]
    assert L.linked_clusters(np.array(vectors)) == plain_clusters(vectors)


def test_clusters_of_a_table(spark):
    rng = random.Random(5)
    rows = [(video, i, [rng.gauss(0, 1) for _ in range(4)]) for video in ("a", "b") for i in range(12)]
    found = {(r.video_id, r.track_id): r.cluster for r in L.cluster(spark.createDataFrame(rows, "video_id string, track_id int, vector array<double>")).collect()}
    for video in ("a", "b"):
        groups = plain_clusters([v for w, _, v in rows if w == video])
        assert {i: n for n, g in enumerate(groups) for i in g} == {i: n for (w, i), n in found.items() if w == video}


@pytest.mark.parametrize("seed", range(6))
def test_ties_join_the_first_pair(seed):
    """Vectors on a coarse grid: many distances alike, repeated and zero vectors."""
    rng = random.Random(seed)
    vectors = [[rng.choice([0, 0, 1, 2]) for _ in range(3)] for _ in range(rng.randint(2, 20))]
    assert L.linked_clusters(np.array(vectors, float)) == plain_clusters(vectors)


def test_forests_join_what_matrices_join():
    rng = np.random.default_rng(2)
    for _ in range(60):
        close = rng.random((rng.integers(1, 12), rng.integers(1, 12))) < rng.choice([0.05, 0.2, 0.8])
        found = clusters.forest(close)

        def groups(pairs):
            root = {}
            get = lambda x: x if root.setdefault(x, x) == x else get(root[x])  # noqa: B023, E731
            for r, c in pairs:
                root[get(("r", r))] = get(("c", c))  # noqa: B023
            by = {}
            for x in list(root):
                by.setdefault(get(x), set()).add(x)
            return sorted(map(sorted, by.values())), len(root) - len(by)

        every, fewest = groups(np.argwhere(close).tolist())
        assert groups(found)[0] == every and len(found) == fewest and all(close[r, c] for r, c in found)


@pytest.mark.parametrize("pivot_bytes", [16 << 20, 0])
def test_large_keys_equal_small_ones(spark, monkeypatch, pivot_bytes):
    """Keys cut into components and blocks, with ties, copies, zero and null vectors, and a small key beside them."""
    rng = random.Random(6)
    rows = []
    for video, n in (("a", 160), ("b", 90), ("c", 5)):
        centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(9)]
        for i in range(n):
            v = [c + rng.gauss(0, rng.choice([0.1, 0.6])) for c in rng.choice(centres)]
            v = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0] if i % 9 == 0 else [float(rng.choice([0, 1])) for _ in v] if i % 9 == 1 else None if i == 11 else [0.0] * 6 if i in (12, 13) else v
            rows.append((video, i * 3 % 1000, v))
    df = spark.createDataFrame(rows, "video_id string, track_id int, vector array<double>").repartition(3)
    whole = sorted(map(tuple, L.cluster(df).collect()))
    monkeypatch.setattr(clusters, "SMALL", 8)
    monkeypatch.setattr(clusters, "BLOCK", 7)
    monkeypatch.setattr(clusters, "PIVOT_BYTES", pivot_bytes)
    assert sorted(map(tuple, L.cluster(df).collect())) == whole and len({c for *_, c in whole}) > 8


def test_vectors_without_links_see_no_solver(spark, monkeypatch):
    """Of a large key only components go to Python, as lone vectors and their copies are most of it."""
    solver = clusters.linked_clusters

    def strict(vectors, most=0.45):
        assert len(np.unique(vectors, axis=0)) > 1
        return solver(vectors, most)

    lone = np.eye(30)
    near = lone + 0.1 * np.roll(lone, 1, axis=1)
    data = np.concatenate([lone, lone[20:], near[:5], np.zeros((2, 30))])
    rows = [("v", 2 * i, v.tolist()) for i, v in enumerate(data)]
    monkeypatch.setattr(clusters, "SMALL", 8)
    monkeypatch.setattr(clusters, "BLOCK", 10)
    monkeypatch.setattr(clusters, "linked_clusters", strict)
    found = {r.track_id: r.cluster for r in L.cluster(spark.createDataFrame(rows, "video_id string, track_id int, vector array<double>")).collect()}
    assert found == {2 * i: n for n, g in enumerate(solver(data)) for i in g}


def test_a_key_of_many_vectors(spark):
    """One key of more vectors than a task takes, in many groups far apart: each comes back whole."""
    groups, each, width = 300, 20, 64
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(groups, width))
    data = (centres[:, None] + rng.normal(scale=0.2, size=(groups, each, width))).reshape(-1, width)
    pdf = pd.DataFrame({"video_id": "v", "track_id": np.arange(len(data)), "vector": data.tolist()})
    found = L.cluster(spark.createDataFrame(pdf, "video_id string, track_id int, vector array<double>")).toPandas()
    assert len(found) == len(data) > clusters.SMALL
    assert (found["cluster"] == found["track_id"] // each).all()


# --- speakers


def plain_assign(scores, speakers, faces):
    """(face, candidate, margin, ambiguous, merged, reason) of each speaker; scores: (face, speaker) -> (score, coverage)."""
    out = {}
    good = {k: v for k, v in scores.items() if v[0] is not None and v[1] >= 0.25}
    if faces:
        cost = [[-good[f, s][0] if (f, s) in good else 1000.0 for f in faces] for s in speakers]
        seats = {speakers[r]: faces[c] for r, c in plain_matching(cost) if (faces[c], speakers[r]) in good}
    for s in speakers:
        if not faces:
            out[s] = "F000", None, 0.0, False, False, "no faces were tracked in this video"
            continue
        own = [(good[f, s][0], f) for f in faces if (f, s) in good]
        if not own:
            out[s] = "F000", None, 0.0, False, False, "no face was on screen for enough of this speaker's speech"
            continue
        seat = seats.get(s)
        best = min(own, key=lambda x: (-x[0], x[1]))
        score, face = next(x for x in own if x[1] == seat) if seat else best
        rival = max((x for x in own if x[1] != face), default=None)
        margin = score - rival[0] if rival else score
        if score < 0.05:
            out[s] = "F000", face, margin if seat else 0.0, False, False, f"best face {face} scored {score:.3f}, below the 0.050 floor; treated as off-screen"
        elif not seat:
            out[s] = face, face, margin, margin < 0.05, True, f"{face} scored {score:.3f}; shared with a higher-scoring speaker, so this cluster is treated as a split of the same person"
        elif margin < 0.05 and rival:
            out[s] = face, face, margin, True, False, f"{face} scored {score:.3f} against {rival[1]} at {rival[0]:.3f}; margin below 0.050"
        else:
            out[s] = face, face, margin, margin < 0.05, False, f"{face} scored {score:.3f} over coverage {good[face, s][1]:.2f}"
    return out


def test_speaker_assignment_equals_a_plain_one(spark):
    rng = random.Random(11)
    rows, voices, expected = [], [], {}
    for v in range(60):
        faces = [f"F{i:03d}" for i in range(1, rng.randint(0, 4) + 1)]
        speakers = [f"s{i}" for i in range(rng.randint(1, 4))]
        scores = {(f, s): (rng.choice([None, rng.uniform(-0.3, 1), rng.uniform(0.4, 0.5)]), rng.uniform(0, 1)) for f in faces for s in speakers}
        rows += [(v, f, s, x, c) for (f, s), (x, c) in scores.items()]
        voices += [(v, s) for s in speakers]
        expected |= {(v, s): x for s, x in plain_assign(scores, speakers, faces).items()}
    found = L.assign_speakers(spark.createDataFrame(rows, "video_id long, face string, speaker string, score double, coverage double"), spark.createDataFrame(voices, "video_id long, speaker string"))
    found = {(r.video_id, r.speaker): (r.face, r.candidate, r.margin, r.ambiguous, r.merged, r.reason) for r in found.collect()}
    assert set(found) == set(expected)
    for k, want in expected.items():
        assert found[k][:2] == want[:2] and abs(found[k][2] - want[2]) < 1e-9 and found[k][3:] == want[3:], k


def test_speaker_scores_equal_plain_ones(spark):
    rng = random.Random(12)
    visible, samples, turns, expected = [], [], [], {}
    for v in range(8):
        spans = lambda n: [(s := rng.uniform(0, 50), s + rng.uniform(0.5, 15)) for _ in range(rng.randint(1, n))]  # noqa: B023, E731
        shown, said = {f: spans(4) for f in ("F001", "F002")}, {s: spans(5) for s in ("a", "b", "c")}
        heard = {f: [(rng.uniform(0, 60), rng.random()) for _ in range(40)] for f in shown}
        visible += [(v, f, *x) for f, xs in shown.items() for x in xs]
        samples += [(v, f, *x) for f, xs in heard.items() for x in xs]
        turns += [(v, s, *x) for s, xs in said.items() for x in xs]
        grid = np.arange(0, 70, 0.001) + 0.0005
        on = lambda xs: np.any([(a <= grid) & (grid < b) for a, b in xs], axis=0)  # noqa: B023, E731
        for f in shown:
            for s, xs in said.items():
                inside = [p for t, p in heard[f] if any(a <= t < b for a, b in xs)]
                outside = [p for t, p in heard[f] if not any(a <= t < b for a, b in xs)]
                score = sum(inside) / len(inside) - 0.5 * (sum(outside) / len(outside) if outside else 0) if inside else None
                expected[v, f, s] = score, (on(shown[f]) & on(xs)).sum() / on(xs).sum()
    frame = lambda rows, what: spark.createDataFrame(pd.DataFrame(rows), f"video_id long, {what}")
    found = L.speaker_scores(frame(visible, "face string, start double, end double"), frame(samples, "face string, t double, p double"), frame(turns, "speaker string, start double, end double"))
    found = {(r.video_id, r.face, r.speaker): (r.score, r.coverage) for r in found.collect()}
    assert set(found) == set(expected)
    for k, (score, coverage) in expected.items():
        assert (found[k][0] is None) == (score is None) and abs((found[k][0] or 0) - (score or 0)) < 1e-9 and abs(found[k][1] - coverage) < 0.005
