"""All twelve stages over a small corpus with stand-in models, and what runs again."""

import pytest
from pyspark.sql import functions as F

from spanweave import models, stage_queries
from spanweave.operators import solvers
from spanweave.plans import lineage as N
from spanweave.plans import stages
from spanweave.storage import cut, forget, scratch

PROBE = '{"streams":[{"codec_type":"video","r_frame_rate":"25/1","nb_frames":"225","width":640,"height":360}%s],"format":{"duration":"9.0"}}'
SOUND = ',{"codec_type":"audio","sample_rate":"16000","channels":1}'
CONFIG = {
    "s1-faces": {"stride": 3, "models": {"detector": lambda: models.two_faces}},
    "s4-diarize": {"models": {"diarizer": lambda: models.two_voices}},
    "s5-asd": {"models": {"speaking": lambda: models.first_half}},
    "s8-asr": {"models": {"transcriber": lambda: models.echo}},
    "s9-paralinguistic": {"models": {"tagger": lambda: models.moods}},
    "s10-caption": {"models": {"captioner": lambda: models.plain_caption}},
}


def corpus(spark):
    return {
        "sources": spark.createDataFrame([(v, f"/m/{v}.mp4") for v in "abc"], "video_id string, path string"),
        "answers": spark.createDataFrame([("a", PROBE % SOUND), ("b", PROBE % SOUND), ("c", PROBE % "")], "video_id string, probe string"),
        "logs": spark.createDataFrame([("a", "pts_time:4.2 x"), ("b", "")], "video_id string, log string"),
    }


def test_all_stages_in_order(spark):
    made, records = stages.run_stages(corpus(spark), stages.available(), CONFIG, store=cut)
    said = {(r.video_id, r.stage): (r.status, r.reason) for r in records.collect()}
    assert said["a", "s0-preprocess"] == ("ok", "no previous run") and said["c", "s0-preprocess"][0] == "failed"
    assert {s for v, s in said if v == "a"} == set(stages.available()) and {s for v, s in said if v == "c"} == {"s0-preprocess"}
    assert made["shots"].where("video_id = 'a'").count() == 2 and made["shots"].where("video_id = 'b'").count() == 1
    assert {(r.video_id, r.face, len(r.track_ids)) for r in made["identities"].collect()} == {(v, f, 1) for v in "ab" for f in ("F001", "F002")}
    assert {(r.video_id, r.speaker, r.face) for r in made["assignments"].collect()} == {(v, s, f) for v in "ab" for s, f in (("spk_00", "F001"), ("spk_01", "F002"))}
    script = made["scripts"].where("video_id = 'a'").first().script
    assert "[SHOT 1 0.0s-4.2s]\nShot 1 shows F001.\n<F001> laughter: <S>F001_0000<E>\n\n[SHOT 2 4.2s-9.0s]" in script and "<F002> laughter: <S>F002_0000<E>" in script
    gates = {(r.video_id, r.gate): r.passed for r in made["gates"].collect()}
    assert len(gates) == 10 and all(gates.values())
    assert made["documents"].count() == 2 and made["metrics"].where("utterance_count = 2 and face_count = 2").count() == 2


def test_only_what_changed_runs_again(spark):
    tables, first = stages.run_stages(corpus(spark), ("s0-preprocess", "s4-diarize"), CONFIG, store=cut)
    state = cut(first.withColumn("finished_at", F.lit(1)))
    again, second = stages.run_stages(tables, ("s0-preprocess", "s4-diarize"), CONFIG, state=state, store=cut)
    assert {(r.video_id, r.stage, r.reason) for r in second.collect()} == {("c", "s0-preprocess", "previous run failed")}
    assert sorted(r.video_id for r in again["turns"].collect()) == ["a", "a", "b", "b"]
    tables["answers"] = spark.createDataFrame([("a", (PROBE % SOUND).replace("9.0", "3.0")), ("b", PROBE % SOUND), ("c", PROBE % "")], "video_id string, probe string")
    changed, third = stages.run_stages(tables, ("s0-preprocess", "s4-diarize"), CONFIG, state=state, store=cut)
    assert {(r.video_id, r.stage, r.reason) for r in third.collect()} == {("a", "s0-preprocess", "inputs changed"), ("a", "s4-diarize", "inputs changed"), ("c", "s0-preprocess", "previous run failed")}
    assert {(r.video_id, r.end) for r in changed["turns"].collect()} == {("a", 3.0), ("b", 4.0), ("b", 9.0)}
    merged = stages.upsert(state, third.withColumn("finished_at", F.lit(2)))
    assert merged.count() == state.count() and N.first_failures(merged).first().video_id == "c"


def test_each_segment_is_transcribed_once(spark, tmp_path):
    folder = str(tmp_path)

    def counted(name, audio=None, language=None):
        import uuid

        open(f"{folder}/{name}-{uuid.uuid4().hex}", "w").close()
        return models.echo(name, audio, language)

    segments = spark.range(12).selectExpr("id % 3 video_id", "'F001' identity", "concat('F001_', id) name", "id * 10.0D start", "id * 10.0D + 1 + id % 2 * 4 end", "1.0D + id % 2 * 4 duration", "'original' source")
    made = stages.transcribe({"segments": segments}, {"models": {"transcriber": lambda: counted}})
    said = {r.name: r.text for r in made["transcripts"].collect()}
    assert said == {f"F001_{i}": f" F001_{i}" for i in range(12)} and made["language"].count() == 3 and made["failed"].count() == 0
    assert sorted(f.name.split("-")[0] for f in tmp_path.iterdir()) == sorted(said)


def test_no_table_of_videos_is_broadcast(spark, sf, monkeypatch):
    plans = []

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("\n"))
        return cut(df)

    for module in (stage_queries, stages, solvers):
        monkeypatch.setattr(module, "cut", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # more than each table's files have here
    try:
        seen(stage_queries.q_stages(spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    sent = [p[i + 1 : i + 3] for p in plans for i, line in enumerate(p) if "BroadcastExchange" in line]
    assert len(plans) > 10 and all("Scan ExistingRDD[dimension" in "".join(x) for x in sent), sent


def test_registry(spark):
    assert len(stages.available()) == 12 and stages.uses_gpu("s1-faces") and not stages.uses_gpu("s2-tracks") and stages.uses_gpu("nothing")
    with pytest.raises(KeyError, match="known stages"):
        stages.get_stage("nothing")
    with pytest.raises(FileNotFoundError, match="run s2-tracks first"):
        stages.run_stages({"videos": spark.range(1)}, ("s5-asd",))
    with pytest.raises(ValueError, match="no model"):
        stages.run_stages({"videos": spark.createDataFrame([("a",)], "video_id string")}, ("s4-diarize",))


def test_tables_are_written_and_deleted(spark):
    df = cut(spark.range(5))
    assert df.count() == 5 and df._spanweave_path.startswith(scratch(spark))
    forget(df, None, spark.range(1))
    with pytest.raises(Exception, match="(?i)not.*exist|no such file"):
        spark.read.parquet(df._spanweave_path).count()
