"""Settings, stored tables, state documents and the command line."""

import hashlib
import json

import numpy as np
import pytest
from test_stages import PROBE, SOUND

from spanweave import __main__ as cli
from spanweave.plans import config as K
from spanweave.sources import readers as R
from spanweave.sources.published import Published


def test_settings(tmp_path):
    (tmp_path / "s1.faces.json").write_text('{"stride": 2, "name": "x", "on": true, "weights": "w/a.bin"}')
    found = K.load_all(str(tmp_path), cli.FILES)
    assert set(found) == {"s1-faces"}
    c = found["s1-faces"]
    assert K.whole(c, "stride", 3, 1) == 2 and K.text(c, "name", "") == "x" and K.flag(c, "on", False) and K.number(c, "other", 0.5) == 0.5
    assert K.path(c, "weights") == str(tmp_path / "w/a.bin") and K.path(c, "nothing") is None and K.path({"p": "/a"}, "p") == "/a"
    for call in (lambda: K.number(c, "on", 1), lambda: K.number(c, "name", 1), lambda: K.whole({"a": 1.5}, "a", 1), lambda: K.number(c, "stride", 1, 5), lambda: K.flag(c, "stride", True), lambda: K.text(c, "stride", "")):
        with pytest.raises(ValueError, match="must be"):
            call()
    (tmp_path / "bad.json").write_text("[1]")
    with pytest.raises(ValueError, match="object"):
        K.load(str(tmp_path / "bad.json"))


def test_stored_tables_and_state_documents(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run s4-diarize first"):
        R.read_stored(spark, str(tmp_path), "turns", "s4-diarize")
    R.write_lines(spark.createDataFrame([("v", "A", 0.0, 1.0)], R.SCHEMAS["turns"]), str(tmp_path / "turns"), by=None)
    assert R.read_stored(spark, str(tmp_path), "turns", "s4-diarize").first().speaker == "A"
    (tmp_path / "docs").mkdir()
    (tmp_path / "docs" / "a.json").write_text(json.dumps({"stages": [{"stage": "s0", "status": "ok", "artifacts": [{"path": "p", "sha256": "h", "size": 3}]}, {"status": "ok"}]}, indent=1))
    (tmp_path / "docs" / "b.json").write_text("{broken")
    docs = R.read_documents(spark, str(tmp_path / "docs"))
    assert docs.count() == 2
    states = R.stage_states(docs.withColumnRenamed("path", "video_id")).collect()
    assert [(r.stage, r.status, r.artifacts[0].size) for r in states] == [("s0", "ok", 3)]
    hashes = {r.path.rpartition("/")[2]: (r.sha256, r.size) for r in R.file_hashes(spark, str(tmp_path / "docs")).collect()}
    assert hashes["b.json"] == (hashlib.sha256(b"{broken").hexdigest(), 7)


def test_half_float_vectors(spark):
    x = np.array([0, -0.0, 1, -2.5, 65504, 6e-8, 3.1416, np.inf], np.float16)
    rows = spark.createDataFrame([(1, bytearray(x.tobytes())), (2, bytearray()), (3, None)], "id int, vec binary")
    found = {r.id: r.vec for r in R.vectors(rows).collect()}
    assert np.array_equal(np.array(found[1], np.float32), x.astype(np.float32)) and found[2] is None and found[3] is None


def test_run_and_report(spark, tmp_path, capsys):
    folder = str(tmp_path)
    for name, rows, schema in (
        ("sources", [("a", "/m/a.mp4"), ("c", "/m/c.mp4")], "video_id string, path string"),
        ("answers", [("a", PROBE % SOUND), ("c", PROBE % "")], "video_id string, probe string"),
        ("logs", [("a", "pts_time:4.2 x")], "video_id string, log string"),
        ("model_diarizer", [("a", "s", 0.0, 2.0)], "video_id string, speaker string, start double, end double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    assert cli.main(["stages"]) == 0 and "s2-tracks  s2-v1  cpu" in capsys.readouterr().out
    assert cli.main(["run", folder, "--stage", "s0-preprocess", "--stage", "s4-diarize"], spark) == 1
    assert Published(spark, folder).table("turns").count() == 1
    assert cli.main(["report", folder], spark) == 1
    said = capsys.readouterr().out
    assert "Videos: 2 of 2 that are listed" in said and "| c | s0-preprocess | ValueError: the video has no audio stream |" in said
    assert cli.main(["report", folder, "--out", f"{folder}/report"], spark) == 1 and spark.read.text(f"{folder}/report").count() > 10
    assert cli.main(["report", folder, "--json"], spark) == 1
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {"kind": "totals", "videos": 2, "done": 0, "not_done": 2, "listed": 2} in said and sum(x["kind"] == "video" for x in said) == 2
    with pytest.raises(SystemExit):
        cli.main(["run", folder, "--stage", "nothing"], spark)
    with pytest.raises(SystemExit):
        cli.main(["run", folder, "--limit", "0"], spark)


def test_runs_of_some_videos(spark, tmp_path):
    """Files, folders and lists name videos, and a limit takes the first."""
    folder, media = str(tmp_path / "tables"), tmp_path / "media"
    (media / "sub").mkdir(parents=True)
    for name in ("b.mp4", "sub/d.mkv", ".hidden.mp4", "notes.txt"):
        (media / name).write_bytes(b"x")
    (tmp_path / "list.txt").write_text("# a list\n\nc\n  sub/a.mp4\nc\n")
    for name, rows, schema in (
        ("sources", [(v, f"/m/{v}.mp4") for v in "abcd"], "video_id string, path string"),
        ("answers", [(v, PROBE % SOUND) for v in "abcd"], "video_id string, probe string"),
        ("logs", [(v, "") for v in "abcd"], "video_id string, log string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    assert cli.asked_for(spark, [str(media)], None, None) == ["b", "d"]
    assert cli.asked_for(spark, ["/x/y/z.mp4", str(media)], str(tmp_path / "list.txt"), 4) == ["z", "b", "d", "c"]
    with pytest.raises(ValueError, match="no videos"):
        cli.asked_for(spark, [], str(_empty(tmp_path)), None)
    ran = lambda: sorted(r.video_id for r in Published(spark, folder).table("videos").collect())
    assert cli.main(["run", folder, "--stage", "s0-preprocess", "--limit", "1"], spark) == 0 and ran() == ["a"]
    assert cli.main(["run", folder, "--stage", "s0-preprocess", "--input", str(media / "b.mp4")], spark) == 0 and ran() == ["a", "b"]
    assert cli.main(["run", folder, "--stage", "s0-preprocess", "--list", str(tmp_path / "list.txt")], spark) == 0 and ran() == ["a", "b", "c"]
    assert cli.main(["run", folder, "--stage", "s0-preprocess"], spark) == 0 and ran() == ["a", "b", "c", "d"]


def _empty(folder):
    (folder / "empty.txt").write_text("# nothing\n")
    return folder / "empty.txt"
