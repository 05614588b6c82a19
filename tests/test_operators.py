"""Operators on small cases, against plain Python."""

import itertools
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from spanweave import catalog, corpus_queries
from spanweave.functions import text as X
from spanweave.operators import compose as C
from spanweave.operators import intervals as I
from spanweave.operators import joins as J
from spanweave.operators import qa as Q
from spanweave.operators import script as G
from spanweave.operators import solvers as L
from spanweave.operators import speech as S
from spanweave.operators import tags as T
from spanweave.plans import batch as B
from spanweave.plans import lineage as N
from spanweave.sources import readers as R
from spanweave.streaming import live


def spans(spark, rows):
    return spark.createDataFrame([(v, float(s), float(e)) for v, s, e in rows], "video_id string, start double, end double")


def got(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# --- intervals


def test_merge_closes_the_gap_at_its_bound(spark):
    rows = [("v", 0, 5), ("v", 1, 2), ("v", 4, 6), ("v", 6, 7), ("v", 7.25, 8), ("v", 9, 9.5)]
    assert got(I.merge(spans(spark, rows), max_gap=0.25), "start", "end") == [(0.0, 8.0), (9.0, 9.5)]


def test_clean_turns(spark):
    rows = [("v", "A", 0.0, 3.0), ("v", "B", 2.0, 5.0), ("v", "A", 5.0, 6.0)]
    turns = spark.createDataFrame(rows, "video_id string, speaker string, start double, end double")
    kept = S.clean_turns(turns, F.lit(5.5))
    assert got(kept, "speaker", "start", "end") == [("A", 0.0, 3.0), ("A", 5.0, 5.5), ("B", 2.0, 5.0)]
    summary = S.speech_summary(kept).first()
    assert (summary.speakers, summary.overlap_length, summary.speech_length) == (2, 1.0, 5.5)


def test_a_turn_without_length_overlaps_nothing(spark):
    turns = spark.createDataFrame([("v", "A", 2.0, 2.0), ("v", "B", 3.0, 4.0)], "video_id string, speaker string, start double, end double")
    assert I.overlaps(turns, "speaker").count() == 0


def sides_with_points(spark, seed):
    """Two sides of spans, every third without length, and the pairs of their merged spans that meet by the SQL's condition."""
    rng = random.Random(seed)
    rows = [[(v, s, s + rng.choice((0, 2, 5))) for v in "uvwx" for s in rng.sample(range(0, 60), rng.randint(1, 8))] for _ in range(2)]
    rows[0].append(("p", 3, 3)), rows[1].append(("p", 1, 9)), rows[0].append(("q", 1, 9)), rows[1].append(("q", 9, 9))
    sides = [spans(spark, r) for r in rows]
    a, b = (got(I.merge(s), "video_id", "start", "end") for s in sides)
    return sides, [(v, max(s, t), min(e, f)) for v, s, e in a for w, t, f in b if v == w and s < f and t < e]


@pytest.mark.parametrize("seed", range(3))
def test_intersect_keeps_points_inside_the_other_side(spark, seed):
    sides, met = sides_with_points(spark, seed)
    assert ("p", 3.0, 3.0) in met and "q" not in {v for v, _, _ in met}
    assert got(I.intersect(*sides, points=True), "video_id", "start", "end") == sorted(met)
    assert got(I.intersect(*sides), "video_id", "start", "end") == sorted(m for m in met if m[2] > m[1])


@pytest.mark.parametrize("seed", range(3))
def test_overlap_total_has_keys_that_meet_in_points(spark, seed):
    sides, met = sides_with_points(spark, seed)
    want = {v: sum(e - s for w, s, e in met if w == v) for v, _, _ in met}
    assert want["p"] == 0 and dict(got(I.overlap_total(*sides, points=True), "video_id", "length")) == want
    assert dict(got(I.overlap_total(*sides), "video_id", "length")) == {v: n for v, n in want.items() if n}


def zero_events(spark, folder):
    """A folder of events in which some turns have no length: users meet in points alone, in spans, at bounds and not."""
    rows, n = [], 0
    for user, turns in enumerate(([("view", 0, 300), ("error", 12, 0)], [("view", 12, 0), ("error", 0, 300)], [("view", 0, 300), ("error", 30, 0)], [("view", 0, 36), ("error", 18, 36), ("click", 20, 0)], [("view", 5, 0), ("error", 5, 0)])):
        for kind, hour, value in turns:
            rows.append((n, "2024-01-05 00:00:00", hour, user, kind, float(value)))
            n += 1
    made = spark.createDataFrame(rows, "event_id long, day string, hours int, user_id long, event_type string, value double")
    made = made.withColumn("ts", F.to_timestamp_ntz("day") + F.make_dt_interval(hours=F.col("hours"))).drop("day", "hours")
    made.write.parquet(f"{folder}/events.parquet")


@pytest.mark.parametrize("name", ["q_owner_overlap", "q_context_speakers"])
def test_turns_without_length_equal_the_sql(spark, tmp_path, name):
    zero_events(spark, tmp_path)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    cursor = db.execute(catalog.ORACLE_SQL[name])
    columns, want = [c[0] for c in cursor.description], cursor.fetchall()
    assert got(catalog.QUERIES[name](spark, str(tmp_path)), *columns) == sorted(want) and want


def grid(rows, n=24):
    cover = [set() for _ in range(n)]
    for _, s, e in rows:
        for t in range(s, e):
            cover[t].add(1)
    return [bool(c) for c in cover]


def runs(flags):
    out, start = [], None
    for t, f in enumerate([*flags, False]):
        if f and start is None:
            start = t
        elif not f and start is not None:
            out.append((float(start), float(t)))
            start = None
    return out


def test_set_algebra_on_random_spans(spark):
    rng = random.Random(1)
    a, b = [], []
    for v in range(40):
        for side in (a, b):
            for _ in range(rng.randint(0, 5)):
                s = rng.randint(0, 20)
                side.append((str(v), s, s + rng.randint(0, 4)))
    left, right = spans(spark, a), spans(spark, b)
    found = {n: f(left.where("end > start"), right.where("end > start")).collect() for n, f in (("both", I.intersect), ("less", I.subtract))}
    lengths = {r.video_id: r.length for r in I.union_length(left).collect()}
    for v in map(str, range(40)):
        x, y = grid([r for r in a if r[0] == v]), grid([r for r in b if r[0] == v])
        assert sorted((r.start, r.end) for r in found["both"] if r.video_id == v) == runs([p and q for p, q in zip(x, y, strict=True)])
        assert sorted((r.start, r.end) for r in found["less"] if r.video_id == v) == runs([p and not q for p, q in zip(x, y, strict=True)])
        assert lengths.get(v, 0) == sum(x)


def test_presence(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("b", 1.0), ("b", 3.0), ("b", 7.0), ("b", 15.0)], "video_id string, t double")
    assert got(I.presence(df), "video_id", "start", "end") == [("a", 1.0, 1.1), ("b", 0.0, 19.0)]


def test_bad_intervals_fail(spark):
    with pytest.raises(Exception, match="ends before it starts"):
        I.checked(spans(spark, [("v", 2, 1)])).collect()


# --- joins


@pytest.mark.parametrize("kind", ["long", "double"])
def test_overlap_join_equals_the_plain_one(spark, kind):
    """Lengths from nothing to 10^9, bounds alike, a video with most rows, nulls."""
    rng = random.Random(2)

    def make(n):
        rows = []
        for i in range(n):
            start = rng.choice([rng.randint(-(10**9), 10**9), rng.randint(0, 200), rng.randint(-50, 50)])
            length = rng.choice([0, 1, rng.randint(0, 40), int(10 ** rng.uniform(0, 9))])
            start, end = (start, start + length) if kind == "long" else (start / 7, start / 7 + length / rng.choice([1, 1e6]))
            rows.append((rng.choice(["v", "v", "w"]), start, end, i))
        return [*rows, (None, rows[0][1], rows[0][2], n), ("v", None, rows[0][2], n + 1), ("v", rows[0][1], None, n + 2)]

    a, b = make(150), make(130)
    df = lambda rows, name: spark.createDataFrame(rows, f"video_id string, start {kind}, end {kind}, {name} long")
    found = [(r.x, r.y) for r in J.overlap_join(df(a, "x"), df(b, "y")).collect()]
    plain = [(i, j) for v, s, e, i in a for w, t, u, j in b if None not in (s, e, t, u, v) and v == w and s < u and t < e]
    assert sorted(found) == sorted(plain) and len(plain) > 900
    only = J.overlap_join(df([("v", 5, 5, 0)] if kind == "long" else [("v", 5.0, 5.0, 0)], "x"), df(b, "y"))
    assert sorted(r.y for r in only.collect()) == sorted(j for w, t, u, j in b if None not in (t, u) and w == "v" and t < 5 < u)


def test_overlap_join_makes_few_rows_of_long_intervals(spark):
    rows = [("v", i, i + 10**9, i) for i in range(200)]
    a = spark.createDataFrame(rows, "video_id string, start long, end long, x long")
    found = J.overlap_join(a, a.withColumnRenamed("x", "y"))
    assert found.count() == 200 * 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_nearest_prefers_the_earlier(spark):
    left = spark.createDataFrame([("v", 1.0, 1), ("v", 5.0, 2)], "video_id string, t double, row_id long")
    right = spark.createDataFrame([("v", 0.5, "a"), ("v", 1.5, "b")], "video_id string, t double, p string")
    assert got(J.nearest(left, right, "p", 0.5), "row_id", "p") == [(1, "a"), (2, None)]


def test_utterances_before_all_shots_take_the_first(spark):
    shots = spark.createDataFrame([("v", 1, 0.0), ("v", 2, 4.0), ("v", 3, 2.0)], "video_id string, index int, start double")
    said = spark.createDataFrame([("v", -1.0), ("v", 0.0), ("v", 3.0), ("v", 4.0)], "video_id string, start double")
    assert got(G.to_shots(said, shots), "start", "shot") == [(-1.0, 1), (0.0, 1), (3.0, 1), (4.0, 3)]


# --- tags and texts


def test_tag_precedence_and_margin(spark):
    rows = [("v", "event", "Cough", 0.6), ("v", "delivery", "whispering", 0.9), ("v", "emotion", "angry", 0.95), ("w", "emotion", "生气/angry", 0.7), ("x", "emotion", "neutral", 0.99)]
    found = {r.video_id: r for r in T.reduce_tags(spark.createDataFrame(rows, "video_id string, dimension string, label string, score double"), T.vocabulary(spark), ["video_id"]).collect()}
    assert (found["v"].tag, round(found["v"].margin, 6)) == ("cough", -0.35) and "higher-scoring" in found["v"].reason
    assert (found["w"].tag, found["w"].margin) == ("angry", 0.7) and "x" not in found


def test_text_functions(spark):
    df = spark.createDataFrame([("  生气/Angry_now ", "F001 and F007 , then F007.", "3", 3849.9)], "a string, b string, c string, d double")
    row = df.select(X.slug(F.col("a")), X.without_references(F.col("b"), F.array(F.lit("F007"))), X.speaker_name(F.col("c")), X.duration_text(F.col("d")), X.tag(F.lit(" ")), X.face_number(F.lit("F012"))).first()
    assert tuple(row) == ("生气-angry-now", "F001 and, then.", "spk_03", "1h 04m 10s", None, 12)


def test_script_round_trip(spark):
    videos = spark.createDataFrame([("v", "A room.", 9.0)], "video_id string, caption string, duration double")
    shots = spark.createDataFrame([("v", 1, 0.0, 4.0, "One."), ("v", 2, 4.0, 9.0, None)], "video_id string, index int, start double, end double, caption string")
    rows = [("v", "F001", "calm", "Hello there", 0.5, 1.0), ("v", "F000", None, "Oh", 5.0, 6.0), ("v", "F002", None, "a < b", 6.0, 7.0)]
    said = spark.createDataFrame(rows, "video_id string, face string, tag string, text string, start double, end double")
    script = G.render(videos, shots, said)
    expected = "[GLOBAL]\nA room.\n\n[SHOT 1 0.0s-4.0s]\nOne.\n<F001> calm: <S>Hello there<E>\n\n[SHOT 2 4.0s-9.0s]\n<F000> <S>Oh<E>\n"
    assert script.first().script == expected
    assert got(G.parse(script), "position", "shot", "face", "text") == [(0, 1, "F001", "Hello there"), (1, 2, "F000", "Oh")]
    gates = {r.gate: r.violations for r in Q.gates(said, spark.createDataFrame([("v", "F001")], "video_id string, face string"), videos.withColumn("voiced", F.lit(2.5)), scripts=script).collect()}
    assert gates == {"format_hygiene": 1, "id_integrity": 1, "timeline_sanity": 0, "speech_accounting": 0, "render_round_trip": 1}


# --- solvers


def brute_matching(cost):
    """Least total over all matchings, by trying each."""
    cost = cost.T if cost.shape[0] > cost.shape[1] else cost
    return min(sum(cost[r, c] for r, c in enumerate(p)) for p in itertools.permutations(range(cost.shape[1]), cost.shape[0]))


def test_matching_is_cheapest():
    rng = np.random.default_rng(0)
    assert L.cheapest_matching([[1, 2], [1, 100]]) == [(0, 1), (1, 0)] and L.cheapest_matching(np.zeros((0, 3))) == []
    for _ in range(200):
        cost = rng.integers(0, 9, (rng.integers(1, 6), rng.integers(1, 7))).astype(float)
        assert sum(cost[r, c] for r, c in L.cheapest_matching(cost)) == brute_matching(cost)
    pairs, rows, columns = L.matched(np.array([[0.1, 0.9], [0.9, 0.95]]), 0.5)
    assert (pairs, rows, columns) == ([(0, 0)], [1], [1])


def test_clusters():
    v = np.array([[1, 0, 0], [0.99, 0.1, 0], [0, 1, 0], [0, 0, 0]])
    assert L.linked_clusters(v) == [[0, 1], [2], [3]] and L.linked_clusters(np.zeros((0, 3))) == []


def test_tracker_keeps_and_loses():
    box = lambda x: [x, 100.0, 40.0, 50.0]
    t = L.Tracker(patience=2)
    assert t.frame(np.array([box(100), box(400)]), np.array([0.9, 0.9])) == [1, 2]
    assert t.frame(np.array([box(401), box(101)]), np.array([0.9, 0.3])) == [2, 1]  # a held-back score continues a track
    assert t.frame(np.array([box(700)]), np.array([0.55])) == [0]  # and never begins one
    for _ in range(3):
        t.frame(np.zeros((0, 4)), np.array([]))
    assert t.frame(np.array([box(100)]), np.array([0.9])) == [3]  # unseen for too long


def test_speaker_assignment(spark):
    visible = spark.createDataFrame([("v", f, 0.0, 10.0) for f in ("F001", "F002")], "video_id string, face string, start double, end double")
    samples = spark.createDataFrame([("v", f, t / 10, 1.0 if (f == "F001") == (t < 50) else 0.0) for f in ("F001", "F002") for t in range(100)], "video_id string, face string, t double, p double")
    turns = spark.createDataFrame([("v", "A", 0.0, 5.0), ("v", "B", 5.0, 10.0), ("v", "C", 20.0, 21.0)], "video_id string, speaker string, start double, end double")
    found = {r.speaker: r for r in L.assign_speakers(L.speaker_scores(visible, samples, turns), turns).collect()}
    assert (found["A"].face, found["B"].face, found["C"].face) == ("F001", "F002", "F000")
    assert found["A"].score == 1.0 and not found["A"].merged and found["C"].candidate is None


# --- runs, sources, streams


def test_reasons_to_run(spark):
    state = [("a", "s1", "ok", "1", "x", [("p", "h", 1)], 1), ("b", "s1", "failed", "1", "x", [], 1), ("c", "s1", "ok", "0", "x", [], 1), ("d", "s1", "ok", "1", "y", [], 1), ("e", "s1", "ok", "1", "x", [("q", "h", 1)], 1)]
    state = spark.createDataFrame(state, "video_id string, stage string, status string, code_version string, input_hash string, artifacts array<struct<path:string,sha256:string,size:long>>, finished_at long")
    planned = spark.createDataFrame([(v, "s1", "1", "x") for v in "abcdef"], "video_id string, stage string, code_version string, input_hash string")
    files = spark.createDataFrame([("p", "other", 1)], "path string, sha256 string, size long")
    assert dict(N.reasons_to_run(planned, state, files).select("video_id", "reason").collect()) == {
        "a": "artifact p changed content", "b": "previous run failed", "c": "code changed (0 -> 1)", "d": "inputs changed", "e": "missing artifact q", "f": "no previous run",
    }


def test_media_list(spark):
    files = spark.createDataFrame([("/m/a.mp4",), ("/m/b.mp4",), ("/m/b.mkv",), ("/m/.c.mp4",)], "path string")
    entries = spark.createDataFrame([(0, "# list"), (1, "/m/a"), (2, ""), (3, "/m/b"), (4, "/m/b.mkv"), (5, "/m/a"), (6, "/m/.c")], "position long, value string")
    found = {r.position: (r.path, r.problem) for r in R.media_list(entries, files).collect()}
    assert found == {1: ("/m/a.mp4", None), 3: (None, "ambiguous"), 4: ("/m/b.mkv", None), 6: (None, "missing")}


def test_lines_are_written_and_read_by_schema(spark, tmp_path):
    turns = spark.createDataFrame([("v", "A", 0.0, 1.0)], R.SCHEMAS["turns"])
    R.write_lines(turns, str(tmp_path / "turns"))
    assert got(R.read_lines(spark, str(tmp_path / "turns"), "turns"), "video_id", "speaker", "end") == [("v", "A", 1.0)]
    for schema in R.SCHEMAS.values():
        assert spark.createDataFrame([], schema).count() == 0


def test_live_sessions_equal_merged_spans(spark, tmp_path):
    times = pd.to_datetime(["2024-01-01 00:00:00", "2024-01-01 00:03:00", "2024-01-01 00:20:00", "2024-01-02 00:00:00"])
    spark.createDataFrame(pd.DataFrame({"user_id": [1, 1, 1, 2], "ts": times})).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("user_id long, ts timestamp").parquet(str(tmp_path / "in"))
    run = live.live_sessions(stream, ["user_id"]).writeStream.format("memory").queryName("sessions").outputMode("append").start()
    run.processAllAvailable()
    run.stop()
    assert got(spark.table("sessions"), "user_id", "n") == [(1, 1), (1, 2)]


def test_percent_rounds_as_the_sql_does(spark):
    """Exact ties go to the even digit, and numbers below a tie of which the shortest decimal is one go down."""
    values = [k / 9000 * 100 for k in range(0, 9001, 3)] + [0.05, 0.15, 0.25, 0.35, 1.45, 50.25, 99.95, 99.949999, 100.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r.s for r in df.select(B.one_decimal(F.col("x")).alias("s")).collect()] == [f"{v:.1f}" for v in values]


def test_cosine_pairs_of_a_query_are_all(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "label").toPandas()
    want = sum(int((e.label == label).sum()) - 1 for label in e.label[e.vec_id % 100 == 0])
    assert catalog.QUERIES["q_cosine_pairs"](spark, sf).count() == want


def test_identity_rollup_adds_in_the_order_of_tracklets(spark):
    """And its query rounds as the SQL: eighty persons whose mean is near a tie of the seventh digit."""
    rng = random.Random(5)
    rows = [(1, f, p, f * 100 + p, 0.0, 1.0, 1.0, rng.choice((1, 3, 4, 8, 16)), rng.randrange(101) / 100, 20.0, rng.randrange(97) / 3000) for f in range(80) for p in range(12)]
    cols = ["video_id", "face", "position", "track_id", "first_time", "last_time", "span", "frames", "mean_score", "mean_height", "motion"]
    rng.shuffle(rows)
    member = spark.createDataFrame(rows, cols).repartition(7)
    vectors = spark.createDataFrame([(1, r[3], (r[3] % 7) / 8) for r in rows], "video_id long, track_id long, cohesion double")
    found = {r.face: r for r in C.identity_rollup(member, vectors, rounded=False).collect()}
    for f in range(80):
        own = sorted(r[2:] for r in rows if r[1] == f)
        total, mean = sum(float(r[5]) for r in own), {}
        for name, at in (("mean_score", 6), ("motion", 8)):
            mean[name] = 0.0
            for r in own:
                mean[name] += r[at] * r[5]
        assert (found[f].mean_score, found[f].motion) == (mean["mean_score"] / total, mean["motion"] / total)
    ties = [0.42265624999999996, 0.55828125, 0.01771875, 0.014581249999999999]
    df = spark.createDataFrame([(v,) for v in ties], "x double").select(corpus_queries.rounded("x", 7).alias("x"))
    assert [r.x for r in df.collect()] == [0.4226563, 0.5582812, 0.0177187, 0.0145813] == [duckdb.execute("SELECT round(?::DOUBLE, 7)", [v]).fetchone()[0] for v in ties]


def test_window_groups_are_dealt_by_the_number_of_spans(spark, sf, monkeypatch):
    """Not into as few tasks as the compressed size of their bounds says."""
    monkeypatch.setattr(S, "SPANS_OF_TASK", 50)
    t = catalog.turns(spark, sf).withColumn("w", F.floor(F.col("start") / 86_400_000_000).cast("long"))
    plan = S.window_groups(t, ["video_id", "w"], "speaker")._jdf.queryExecution().toString()
    assert f", {t.count() // 50 + 1}), REPARTITION_BY_NUM" in plan
