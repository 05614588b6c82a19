"""Tables that change all at once: versions, failures half way, and how little a small change reads."""

import collections
import os
import re
import signal
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from spanweave import __main__ as cli
from spanweave.sources import published as P

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(spark, *data):
    return spark.createDataFrame(list(data), "video_id string, x long")


def got(store, name="t"):
    return sorted(map(tuple, store.table(name).select("video_id", "x").collect()))


def test_the_last_part_of_a_video_counts(spark, tmp_path):
    store = P.Published(spark, str(tmp_path))
    assert store.tables() == {} and store.number == 0
    store.publish({"t": (rows(spark, ("a", 1), ("a", 2), ("b", 3), ("c", 4)), None)})
    assert got(store) == [("a", 1), ("a", 2), ("b", 3), ("c", 4)]
    video = lambda *v: spark.createDataFrame([(x,) for x in v], "video_id string")
    store.publish({"t": (rows(spark, ("a", 9)), video("a", "c", "c")), "u": (rows(spark, ("a", 5)), video("a"))})
    assert got(store) == [("a", 9), ("b", 3)] and got(store, "u") == [("a", 5)]
    assert got(P.Published(spark, str(tmp_path))) == [("a", 9), ("b", 3)]
    found = {r.video_id: (r.h, r.n) for r in store.digests()["t"].collect()}
    assert found == {r.video_id: (r.h, r.n) for r in P.digest(store.table("t")).collect()}
    for i in range(12):  # parts become one, and what no manifest names goes
        store.publish({"t": (rows(spark, ("b", i)), video("b"))})
    assert got(store) == [("a", 9), ("b", 11)] and len(store.parts["t"]) < P.MOST
    assert len(os.listdir(tmp_path / "_published")) <= 2 * P.KEPT and len([n for n in os.listdir(tmp_path / "_data") if n.startswith("t-")]) <= 2 * (P.MOST + P.KEPT)
    store.publish({"t": (rows(spark), None)})
    assert got(store) == []


def test_two_at_once_lose_nothing(spark, tmp_path):
    one, two = P.Published(spark, str(tmp_path)), P.Published(spark, str(tmp_path))
    one.publish({"t": (rows(spark, ("a", 1)), None)})
    two.publish({"u": (rows(spark, ("b", 2)), None)})  # it had read the folder before the first
    assert two.number == 2 and got(two) == [("a", 1)] and got(two, "u") == [("b", 2)]
    assert not two.named(2, {})  # a taken number stays taken


def test_what_fails_half_way_changes_nothing(spark, tmp_path):
    store = P.Published(spark, str(tmp_path))
    store.publish({"t": (rows(spark, ("a", 1)), None), "u": (rows(spark, ("a", 1)), None)})
    bad = rows(spark, ("a", 2)).withColumn("x", F.when(F.col("x") > 1, F.raise_error(F.lit("half way"))).otherwise(F.col("x")).cast("long"))
    with pytest.raises(Exception, match="half way"):
        store.publish({"t": (rows(spark, ("a", 7)), None), "u": (bad, None)})
    assert got(P.Published(spark, str(tmp_path))) == [("a", 1)] and got(store, "u") == [("a", 1)]


def test_a_killed_run_leaves_the_old_rows(spark, tmp_path):
    """The process is killed while it writes the second of two tables."""
    P.Published(spark, str(tmp_path)).publish({"t": (rows(spark, ("a", 1)), None), "u": (rows(spark, ("a", 1)), None)})
    code = f"""
import time
from pyspark.sql import SparkSession, functions as F
from spanweave.sources.published import Published
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
store = Published(spark, {str(tmp_path)!r})
new = spark.createDataFrame([("a", 2)], "video_id string, x long")
slow = new.mapInPandas(lambda parts: ((time.sleep(600), p)[1] for p in parts), new.schema)
store.publish({{"t": (new, None), "u": (slow, None)}})
"""
    process = subprocess.Popen([sys.executable, "-c", code], cwd=HERE, start_new_session=True, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    written = lambda: sum(n.startswith("t-") and n.endswith("-digests") and os.path.exists(tmp_path / "_data" / n / "_SUCCESS") for n in os.listdir(tmp_path / "_data"))
    for _ in range(600):
        if written() == 2:  # the first table is there; the second hangs
            time.sleep(1)
            break
        time.sleep(0.2)
    else:
        process.kill()
        raise AssertionError("it never came to the second table")
    os.killpg(process.pid, signal.SIGKILL)
    process.wait(30)
    store = P.Published(spark, str(tmp_path))
    assert got(store) == [("a", 1)] and got(store, "u") == [("a", 1)] and store.number == 1
    store.publish({"t": (rows(spark, ("a", 3)), None)})
    assert got(store) == [("a", 3)]


def scanned(spark, since):
    """Rows that scans of published parts gave, by table and whether of digests, in all queries after one; and the last query."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    total, last = collections.Counter(), since
    executions = store.executionsList()
    for i in range(executions.size()):
        e = executions.apply(i)
        if e.executionId() <= since:
            continue
        last = max(last, e.executionId())
        values, nodes = store.executionMetrics(e.executionId()), store.planGraph(e.executionId()).allNodes()
        for j in range(nodes.size()):
            node = nodes.apply(j)
            if "Scan parquet" in node.name() and (of := re.search(r"/_data/(\w+)-[0-9a-f]{32}(-digests)?", node.desc())):
                for k in range(node.metrics().size()):
                    metric = node.metrics().apply(k)
                    if metric.name() == "number of output rows" and values.contains(metric.accumulatorId()):
                        total[of[1], bool(of[2])] += int(re.sub(r"\D", "", values.apply(metric.accumulatorId()).split("(")[0]) or 0)
    return total, last


def test_one_changed_video_of_many_reads_its_own_rows(spark, tmp_path):
    """A second run with one of 10,000 videos changed does not read the stored turns of the others."""
    from test_stages import PROBE, SOUND

    n, folder = 10_000, str(tmp_path)
    v = F.format_string("v%05d", F.col("id"))
    answer = lambda seconds: F.lit((PROBE % SOUND).replace("9.0", seconds))
    spark.range(n).select(v.alias("video_id"), F.concat(F.lit("/m/"), v, F.lit(".mp4")).alias("path")).write.parquet(f"{folder}/sources.parquet")
    spark.range(n).select(v.alias("video_id"), answer("9.0").alias("probe")).write.parquet(f"{folder}/answers.parquet")
    spark.range(n).select(v.alias("video_id"), F.lit("").alias("log")).write.parquet(f"{folder}/logs.parquet")
    turns = spark.range(n * 20).select(F.format_string("v%05d", F.floor(F.col("id") / 20)).alias("video_id"), F.concat(F.lit("s"), F.col("id") % 2).alias("speaker"), (F.col("id") % 20 * 0.4).alias("start"), (F.col("id") % 20 * 0.4 + 0.2).alias("end"))
    turns.write.parquet(f"{folder}/model_diarizer.parquet")
    names = ["s0-preprocess", "s4-diarize"]
    assert cli.run(spark, folder, names) == 0
    whole = P.Published(spark, folder).table("turns").count()
    assert whole > n
    _, since = scanned(spark, -1)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # the paths of scans, whole
    changed = spark.range(n).select(v.alias("video_id"), F.when(F.col("id") == 4321, answer("3.0")).otherwise(answer("9.0")).alias("probe"))
    changed.write.mode("overwrite").parquet(f"{folder}/answers.parquet")
    try:
        assert cli.run(spark, folder, names) == 0
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    read, _ = scanned(spark, since)
    store = P.Published(spark, folder)
    new = store.table("turns").where("video_id = 'v04321'").agg(F.max("end")).first()[0]
    assert new <= 3.0 and store.table("turns").where("video_id <> 'v04321'").count() == whole - store_rows(spark, folder, "v04321", names)
    # Digests and records are a row for each video and table; of videos, shots and turns only the one's row groups.
    assert [len(store.parts[t]) for t in ("videos", "shots", "turns", "stage_state")] == [2, 2, 2, 2]
    rewritten = store.read(store.parts["turns"][1]["rows"])
    assert {r.video_id for r in rewritten.select("video_id").distinct().collect()} == {"v04321"}
    rows_read = {table: sum(c for (t, digests), c in read.items() if t == table and not digests) for table in ("videos", "shots", "turns")}
    assert sum(c for (_, digests), c in read.items() if digests) >= n and max(rows_read.values()) < n / 2, read
    assert cli.run(spark, folder, names) == 0 and P.Published(spark, folder).table("turns").count() == store.table("turns").count()


def store_rows(spark, folder, video, names):
    """How many turns a video had in the first run: ten of each of two speakers, merged across gaps under 0.25 s."""
    store = P.Published(spark, folder)
    return store.read(store.parts["turns"][0]["rows"]).where(F.col("video_id") == video).count()
