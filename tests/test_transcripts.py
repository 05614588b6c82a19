"""Transcript and caption operators on small cases."""

from pyspark.sql import functions as F

from spanweave.operators import captions as P
from spanweave.operators import transcripts as R

WORD = "array<struct<text:string,start:double,end:double,probability:double>>"


def test_words_are_moved_and_clipped(spark):
    words = [(" Hello", 0.0, 1.0, 0.9), (" there", 1.0, 2.0, None), ("!", 2.0, 2.0, 0.5)]
    df = spark.createDataFrame([(words,)], f"w {WORD}")
    moved = R.offset_words(F.col("w"), F.lit(10.0))
    row = df.select(R.clip_words(moved, F.lit(10.5), F.lit(12.0)).alias("w"), R.words_text(F.col("w")).alias("t")).first()
    assert [x.text for x in row.w] == [" Hello", " there", "!"] and row.t == "Hello there!"
    assert [x.text for x in df.select(R.clip_words(moved, F.lit(10.6), F.lit(11.4)).alias("w")).first().w] == []


def test_utterances(spark):
    segments = spark.createDataFrame([("v", "F001_0000", "F001", -1.0, 3.0, ["short"]), ("v", "F002_0000", "F002", 1.0, 9.0, None), ("v", "F003_0000", "F003", 1.0, 2.0, None)], "video_id string, name string, identity string, start double, end double, segment_flags array<string>")
    said = spark.createDataFrame([("v", "F001_0000", " Hi ", None, -0.5, ["short", "empty"]), ("v", "F002_0000", "  ", 0.9, None, None)], "video_id string, name string, text string, language_probability double, avg_logprob double, flags array<string>")
    tags = spark.createDataFrame([("v", "F001_0000", " Calm")], "video_id string, name string, tag string")
    rows = R.utterances(segments, said, tags, F.lit(2.5)).collect()
    assert [tuple(r) for r in rows] == [("v", "F001_0000", "F001", 0.0, 2.5, "calm", "Hi", -0.5, ["short", "empty"])]


def test_adjacent_segments_join_with_their_flags(spark):
    df = spark.createDataFrame([("v", 0.0, 1.0, ["a"]), ("v", 1.0, 2.0, ["b", "a"]), ("v", 5.0, 6.0, [])], "video_id string, start double, end double, flags array<string>")
    assert sorted((r.start, r.end, r.flags) for r in R.merge_adjacent(df, ["video_id"]).collect()) == [(0.0, 2.0, ["a", "b"]), (5.0, 6.0, [])]


def test_samples_and_crops(spark):
    row = spark.range(1).select(
        P.sample_times(F.lit(0.0), F.lit(8.0), F.lit(2)), P.sample_times(F.lit(3.0), F.lit(8.0), F.lit(1)), P.thinned(F.array(*[F.lit(i) for i in range(10)]), 3), F.struct(*P.even_size(F.lit(1920), F.lit(1081))), P.frame_count(F.lit(10.0))
    ).first()
    assert (row[0], row[1], row[2], tuple(row[3]), row[4]) == ([2.0, 6.0], [3.0], [1, 5, 8], (448, 252), 2)


def test_captions_lose_ids_their_roster_lacks(spark):
    df = spark.createDataFrame([("F001 waves to F002 , F009.", ["F001"], ["F001", "F002"]), ("F002", ["F001"], ["F001", "F002"]), (" fine ", ["F001"], ["F001"])], "text string, roster array<string>, known array<string>")
    rows = P.checked_caption(df).collect()
    assert [(r.caption, r.flags) for r in rows] == [("F001 waves to,.", ["invented", "misattributed"]), ("", ["misattributed", "empty"]), ("fine", [])]
