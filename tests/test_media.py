"""Sound and what other programs say of media, on small cases."""

import io
import os
import struct
import subprocess
import sys
import wave

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spanweave.functions import audio as A
from spanweave.operators import spectra as E
from spanweave.plans import batch as B
from spanweave.sources import media as M
from spanweave.sources import sound


def test_wav_round_trip_and_windows():
    x = np.sin(np.arange(16_000) / 20).astype(np.float32) * 1.2
    raw = A.wav_bytes(x, 16_000)
    with wave.open(io.BytesIO(raw)) as f:
        assert (f.getframerate(), f.getnframes(), f.getnchannels(), f.getsampwidth()) == (16_000, 16_000, 1, 2)
    assert A.wav_info(raw) == (16_000, 16_000, 1)
    back = A.wav_window(raw, 0, 1)
    assert np.abs(back - np.clip(x, -1, 1)).max() < 1e-4
    assert len(A.wav_window(raw, 0.75, 5)) == 4000 and len(A.wav_window(raw, 9, 1)) == 0 and len(A.wav_window(raw, -1, 0.5)) == 8000
    with pytest.raises(ValueError, match="8000"):
        A.wav_window(raw, 0, 1, 8000)
    with pytest.raises(ValueError, match="no samples"):
        A.segment_audio(raw, 5.0, 2.0, 1.0, 16_000)
    assert np.array_equal(A.segment_audio(raw, 5.25, 5.0, 0.5, 16_000), A.wav_window(raw, 0.25, 0.5))
    assert len(A.between(x, 16_000, 0.5, 0.25)) == 0 and len(A.between(x, 16_000, 0.9, 3)) == 1600
    assert len(A.joined([x[:100], x[:50]], 0.01, 16_000)) == 310 and len(A.joined([], 1, 16_000)) == 0
    assert A.rms(np.zeros(0)) == 0 and A.rms([3, -4]) == pytest.approx(np.sqrt(12.5))


def plain_log_mel(x, rate=16_000, fps=25.0):
    """Log-mel features by loops and a slow transform."""
    frame, hop = round(rate * 0.025 * 25 / fps), round(rate * 0.010 * 25 / fps)
    size = 512
    while size // 2 >= frame:
        size //= 2
    mel = lambda hz: 1127.0 * np.log(1 + hz / 700.0)
    edges = [mel(125) + (mel(7500) - mel(125)) * i / 65 for i in range(66)]
    out = []
    for at in range(0, len(x) - frame + 1, hop):
        part = [x[at + i] * 32768.0 * (0.5 - 0.5 * np.cos(2 * np.pi * i / frame)) for i in range(frame)]
        n = np.arange(frame)
        power = [abs(np.sum(part * np.exp(-2j * np.pi * k * n / size))) for k in range(size // 2 + 1)]
        row = []
        for b in range(64):
            low, peak, high = edges[b : b + 3]
            row.append(np.log(sum(p * max(0.0, min((mel(k * rate / size) - low) / (peak - low), (high - mel(k * rate / size)) / (high - peak))) for k, p in enumerate(power) if k) + 0.01))
        out.append(row)
    return np.array(out)


def test_log_mel_equals_a_plain_one():
    x = np.random.default_rng(0).normal(0, 0.1, 1200).astype(np.float32)
    for fps in (25.0, 30.0):
        found = A.log_mel(x, fps=fps)
        assert found.shape[1] == 64 and np.abs(found - plain_log_mel(x.astype(float), fps=fps)).max() < 1e-3
    assert A.window_features(x, 4).shape == (16, 64) and not A.window_features(x[:10], 2).any()
    wrapped = A.window_features(x, 3)
    assert np.array_equal(wrapped[6], wrapped[0])
    with pytest.raises(ValueError):
        A.window_features(x, 0)


def test_speakers_are_padded_and_stacked():
    crops = np.ones((2, 3, 4, 4), np.float32)
    assert A.pad_speakers(crops, 3).shape == (3, 3, 4, 4) and not A.pad_speakers(crops, 3)[2].any()
    with pytest.raises(ValueError):
        A.pad_speakers(crops, 1)
    assert A.stack_speakers([np.zeros((2, 4, 4), np.uint8)] * 2).shape == (2, 2, 4, 4)
    with pytest.raises(ValueError):
        A.stack_speakers([np.zeros((2, 4, 4)), np.zeros((3, 4, 4))])


def test_segments_are_read_from_files(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(A.wav_bytes(np.full(16_000, 0.5), 16_000))
    (tmp_path / "b.wav").write_bytes(A.wav_bytes(np.zeros(8_000), 8_000))
    files = M.read_files(spark, str(tmp_path)).withColumn("path", F.regexp_extract("path", "([^/]*)$", 1))
    heads = {r.path: (r.sample_rate, r.frames, r.channels) for r in M.wav_headers(files).collect()}
    assert heads == {"a.wav": (16_000, 16_000, 1), "b.wav": (8_000, 8_000, 1)}
    rows = [("v", "x", "a.wav", 5.5, 5.0, 0.25), ("v", "y", "b.wav", 0.0, 0.0, 0.1), ("v", "z", "c.wav", 0.0, 0.0, 0.1), ("v", "w", "a.wav", 9.0, 0.0, 0.1)]
    segs = spark.createDataFrame(rows, "video_id string, name string, path string, origin double, file_origin double, seconds double")
    found = {r.name: r for r in M.segment_samples(segs, files).collect()}
    assert len(found["x"].samples) == 4000 and found["x"].rms == pytest.approx(0.5, abs=1e-3) and found["x"].silent is False
    assert "8000" in found["y"].error and "no audio" in found["z"].error and "no samples" in found["w"].error
    made = M.wav_files(M.segment_samples(segs, files).where("name = 'x'").select(F.col("name").alias("path"), "samples")).first()
    assert A.wav_info(bytes(made.content)) == (16_000, 4000, 1)


def test_encoders_workers_and_devices():
    listing = "Encoders:\n V..... = Video\n ------\n V....D libx264rgb  x\n V....D mpeg4   MPEG-4\n A..... aac  AAC\n"
    names = M.encoder_names(listing)
    assert {"libx264rgb", "mpeg4", "aac"} <= names and "libx264" not in names
    assert M.choose_encoder(names) == "mpeg4" and M.choose_encoder({"libx265", "h264_nvenc"}) == "h264_nvenc"
    with pytest.raises(ValueError):
        M.choose_encoder({"vp9"})
    assert B.gpu_list("0, 2,") == (0, 2) and B.gpu_list(" ") is None
    for bad in ("a", ",", "1,x"):
        with pytest.raises(ValueError):
            B.gpu_list(bad)
    assert B.plan_workers((0, 1)) == ((0, 1), 2) and B.plan_workers(()) == ((), 1) and B.plan_workers((0,), cpu_only=True, cores=64) == ((0,), 16) and B.plan_workers((0,), 5) == ((0,), 5)
    with pytest.raises(ValueError):
        B.plan_workers((), 0)
    assert B.thread_share(16, 5) == 3 and B.thread_share(2, 9) == 1


def test_two_sources_of_one_stem_fail(spark):
    rows = spark.createDataFrame([(0, "/m/a.mp4"), (1, "/m/b.mkv"), (2, "/n/a.mkv")], "position long, path string")
    with pytest.raises(Exception, match="same stem"):
        B.plan_jobs(rows).collect()
    assert [r.video_id for r in B.plan_jobs(rows.where("position < 2")).orderBy("position").collect()] == ["a", "b"]


def test_windows_of_wav_files_by_their_bytes(spark, tmp_path):
    """Windows equal those of the whole file read at once; files with further chunks, two channels, errors."""
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, 16_000 * 3 + 100)
    (tmp_path / "a.wav").write_bytes(A.wav_bytes(x, 16_000))
    raw = A.wav_bytes(x[:4000], 8_000)
    (tmp_path / "b.wav").write_bytes(raw[:36] + b"LIST" + struct.pack("<I", 3) + b"abc\0" + raw[36:])
    (tmp_path / "c.wav").write_bytes(b"no sound at all, but long enough to be asked")
    paths = [str(tmp_path / "a.wav"), f"file:{tmp_path}/b.wav", str(tmp_path / "c.wav"), str(tmp_path / "none.wav")]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    heads = {r.path.rpartition("/")[2]: r for r in sound.heads(files).collect()}
    assert (heads["a.wav"].sample_rate, heads["a.wav"].frames, heads["a.wav"].channels, heads["a.wav"].offset) == (16_000, len(x), 1, 44)
    assert (heads["b.wav"].sample_rate, heads["b.wav"].frames, heads["b.wav"].offset) == (8_000, 4000, 56)
    assert "not WAV" in heads["c.wav"].error and heads["none.wav"].error
    found = {(r.path.rpartition("/")[2], r["index"]): r for r in sound.windows(files, 0.5, 0.4).collect()}
    whole = A.wav_bytes(x, 16_000)
    assert sorted(i for p, i in found if p == "a.wav") == list(range(8))
    for i in range(8):
        assert np.array_equal(np.array(found["a.wav", i].samples, np.float32), A.wav_window(whole, i * 0.4, 0.5))
    assert len(found["b.wav", 0].samples) == 4000 and found["c.wav", 0].samples is None and found["none.wav", 0].error
    rows = spark.createDataFrame([(paths[0], 1.0, 0.25, "x"), (paths[0], 9.0, 1.0, "y"), (None, 0.0, 1.0, "z"), (paths[1], 0.0, 1.0, "w")], "path string, start double, seconds double, name string")
    said = {r["name"]: r for r in sound.spans(rows, 16_000, wav=True).collect()}
    assert np.array_equal(A.wav_window(bytes(said["x"].audio), 0, 1), A.wav_window(A.wav_bytes(A.wav_window(whole, 1.0, 0.25), 16_000), 0, 1)) and said["x"].rms > 0.5
    assert "no samples" in said["y"].error and "needs a path" in said["z"].error and "8000 Hz" in said["w"].error


def test_a_large_file_is_read_in_little_memory(spark, tmp_path):
    """A WAV file of 3 GB (a sparse one) whose sound stands near its end; the reader is let have 1 GB."""
    size, at = 3_000_000_000, 2_900_000_000
    path, x = str(tmp_path / "large.wav"), np.arange(-800, 800, dtype="<i2")
    with open(path, "wb") as f:
        f.write(A.wav_bytes(np.zeros(0), 16_000)[:40] + struct.pack("<I", size))
        f.seek(44 + at)
        f.write(x.tobytes())
        f.truncate(44 + size)
    start = at / 2 / 16_000
    code = f"""
import resource, sys
import numpy as np
from spanweave.sources import sound
resource.setrlimit(resource.RLIMIT_DATA, (1 << 30, 1 << 30))
with sound.opened({path!r}) as f:
    rate, frames, channels, offset = sound.head_of(f)
    raw = np.frombuffer(f.read_at(3200, offset + {at}), "<i2")
print(rate, frames, channels, raw.tolist() == list(range(-800, 800)))
"""
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert said.stdout.split() == ["16000", str(size // 2), "1", "True"], said.stderr
    rows = spark.createDataFrame([(path, start, 0.1), (path, 5.0, 0.1)], "path string, start double, seconds double")
    found = {r.start: np.array(r.samples, np.float32) for r in sound.spans(rows).collect()}
    assert np.array_equal(found[start], x.astype(np.float32) / 32768) and not found[5.0].any()


def test_features_of_pieces_are_those_of_the_whole(spark):
    """Pieces of every length, one batch or many, null and empty ones, and a sound too short for a frame."""
    rng = np.random.default_rng(3)
    rows, whole = [], {}
    for video, n in (("a", 9000), ("b", 399), ("c", 400), ("d", 0)):
        x = rng.uniform(-1, 1, n).astype(np.float32)
        whole[video] = A.mel_rows(x)
        at, i = 0, 0
        while at < n or i == 0:
            size = int(rng.integers(0, 700))
            rows.append((video, i, x[at : at + size].tolist() if size else None if i % 2 else []))
            at, i = at + size, i + 1
    df = spark.createDataFrame(rows, "video_id string, index int, samples array<float>").repartition(3)
    found = E.features(df).toPandas().sort_values(["video_id", "row"])
    for video, expected in whole.items():
        own = found[found["video_id"] == video]
        assert own["row"].tolist() == list(range(len(expected)))
        assert not len(expected) or np.allclose(np.stack(own["features"]), expected)
    assert len(whole["a"]) > 50 and len(whole["b"]) == 0 and len(whole["c"]) == 1
    speakers = spark.createDataFrame([("w", 2, [2.0]), ("w", 1, [1.0]), ("x", 5, [5.0])], "window string, speaker int, features array<double>")
    axis = E.padded(speakers, ["window"], 3, ["speaker"], F.array(F.lit(0.0)))
    assert sorted((r.window, r.slot, r.features) for r in axis.collect()) == [("w", 0, [1.0]), ("w", 1, [2.0]), ("w", 2, [0.0]), ("x", 0, [5.0]), ("x", 1, [0.0]), ("x", 2, [0.0])]
    with pytest.raises(Exception, match="2 speakers do not fit"):
        E.padded(speakers, ["window"], 1, ["speaker"], F.array(F.lit(0.0))).collect()


def test_features_of_many_keys_in_one_batch_are_those_of_each(spark, monkeypatch):
    """Sounds of any length, cut anywhere, empty, null and under a frame, in batches that end inside a sound and in slices."""
    monkeypatch.setattr(E, "SAMPLES", 700)
    rng, rows, whole = np.random.default_rng(3), [], {}
    for key in range(40):
        sound = rng.normal(size=int(rng.integers(0, 1500))).astype(np.float32)
        cuts = [0, *sorted(rng.integers(0, len(sound) + 1, int(rng.integers(0, 7))).tolist()), len(sound)]
        whole[key] = A.mel_rows(sound)
        rows += [(key, i, sound[a:b].tolist()) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))] + [(key, 99, None)]
    df = spark.createDataFrame(rows, "video_id long, index long, samples array<float>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = E.features(df).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for key, want in whole.items():
        own = found[found.video_id == key].sort_values("row")
        assert own.row.tolist() == list(range(len(want)))
        assert not len(want) or np.allclose(np.stack(own.features), want, atol=1e-9)


def test_the_front_ends_bank_is_made_once_and_batches_share_spectra():
    """A batch of many short sounds takes few calls of the front end, not one for each sound."""
    A.mel_bank.cache_clear()
    A.mel_rows(np.zeros(400)), A.mel_rows(np.zeros(800))
    assert A.mel_bank.cache_info().misses == 1
    pieces = pa.record_batch([pa.array([1, 1, None, 2, 2]), pa.array([[0.0] * 4, None, [1.0], [2.0] * 9, []], pa.list_(pa.float32()))], ["k", "samples"])
    assert E.firsts([pieces.column(0)], 5).tolist() == [0, 2, 3] and [b.num_rows for b in E.slices(pieces, 1)] == [5]
