"""Model plug-ins, summaries and the streaming tracker."""

import os
import random

from pyspark.sql import functions as F

from spanweave import models
from spanweave.operators import solvers as L
from spanweave.operators import summaries as M
from spanweave.streaming import live


def boxes(spark, frames):
    rows = spark.createDataFrame([("v", i, b"") for i in range(frames)], "video_id string, frame long, image binary")
    return models.run_model(rows, "detector", lambda: models.two_faces)


def test_detector_rows_and_errors(spark):
    found = boxes(spark, 3)
    assert found.count() == 6 and found.where("error is not null").count() == 0

    def failing():
        raise RuntimeError("no weights")

    rows = spark.createDataFrame([("v", "F001_0000", b"", None)], "video_id string, name string, audio binary, language string")
    assert models.run_model(rows, "transcriber", lambda: models.echo).first().text == " F001_0000"
    assert models.run_model(rows, "transcriber", failing).first().error == "RuntimeError: no weights"


def test_summaries(spark):
    found = boxes(spark, 5)
    tally = M.detection_tally(found.groupBy("video_id", "frame").agg(F.collect_list("score").alias("scores"))).first()
    assert (tally.sampled, tally.with_faces, tally.histogram, tally["median"]) == (5, 5, {2: 5}, 0.9)
    tracked = L.track(found)
    summary = M.track_summary(L.track_quality(tracked, 25.0)).first()
    assert (summary.tracks, summary["median"], summary.single) == (2, 5, 0)
    assert sorted(r.frame for r in M.best_sighting(tracked, ["video_id", "track_id"]).collect()) == [0, 0]


def test_live_tracks_equal_the_batch_ones(spark, tmp_path):
    """Frames split over batches, out of order and some late within the limit; afterwards no state is left."""
    rng = random.Random(4)
    rows = []
    for video, first in (("a", 1000), ("b", 1040), ("c", 1400)):
        for f in range(30):
            if f % 11 == 5:
                rows.append((video, f, None, None, None, None, None, first + f))
                continue
            rows += [(video, f, 100.0 + 200 * k + 2 * f, 50.0, 40.0, 50.0, rng.choice([0.9, 0.7, 0.4]), first + f) for k in range(2)]
    moved = sorted(rows, key=lambda r: r[-1] + rng.uniform(0, 8))
    batches = [moved[i : i + 25] for i in range(0, len(moved), 25)]
    # Two rows without a frame move the watermark on, at last past the end of every video.
    batches += [[("z", None, None, None, None, None, None, 10_000)], [("z", None, None, None, None, None, None, 20_000)], [("z", None, None, None, None, None, None, 30_000)]]
    schema = "video_id string, frame long, x double, y double, w double, h double, score double, t long"
    seen = lambda rows: spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("t")).drop("t")
    folder = tmp_path / "in"
    for i, batch in enumerate(batches):
        seen(batch).coalesce(1).write.parquet(str(tmp_path / f"part{i}"))
        (folder).mkdir(exist_ok=True)
        for f in (tmp_path / f"part{i}").glob("*.parquet"):
            f.rename(folder / f"{i:04}.parquet")
            os.utime(folder / f"{i:04}.parquet", (1_000_000 + i, 1_000_000 + i))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        stream = spark.readStream.schema(seen(batches[0]).schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        run = live.live_tracks(stream, quiet=30.0).writeStream.format("memory").queryName("tracks").outputMode("append").start()
        run.processAllAvailable()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in run.recentProgress if p["stateOperators"]]
        run.stop()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
    key = lambda df: sorted((r.video_id, r.frame, r.x, r.track_id) for r in df.collect())
    whole = seen(rows)
    expected = key(L.track(whole.where("score is not null"), frames=whole.select("video_id", "frame")))
    assert key(spark.table("tracks")) == expected != []
    assert max(held) > 0 and held[-1] == 0


def test_a_worker_keeps_one_model():
    made = []
    build = lambda name: lambda: made.append(name) or (lambda: name)
    for name in ("a", "a", "b", "b", "a"):
        assert models.kept("captioner", name, build(name))() == name
    assert made == ["a", "b", "a"]
