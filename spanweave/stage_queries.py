"""A run of the stages from association to composition over events; ``catalog`` imports it.

Hours since FROM stand for seconds.  Views are sightings of the one person of a video, clicks are the
moments at which it was judged to speak, and the other events are turns of as many speakers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import models
from .catalog import FROM, islands_sql, out_sql, query, turns
from .plans import stages
from .storage import cut, unsent

LATE = ("s6-associate", "s7-tse", "s8-asr", "s9-paralinguistic", "s10-caption", "s11-compose")
UNTIL = 650.0


def corpus(spark, d) -> stages.Tables:
    """What the stages before association would have written."""
    hours = lambda c: (F.col(c) - FROM) / 3_600_000_000.0
    t = turns(spark, d).select("video_id", "speaker", "event_id", hours("start").alias("start"), hours("end").alias("end"))
    videos = t.select("video_id").distinct().select("video_id", F.concat(F.lit("/m/"), F.col("video_id").cast("string")).alias("path"), F.lit(UNTIL).alias("duration"), F.lit(25.0).alias("fps"), F.lit(640).alias("width"), F.lit(360).alias("height"))
    seen = t.where("speaker = 'view'").select("video_id", F.lit(1).alias("track_id"), F.col("start").alias("time"))
    track = seen.groupBy("video_id", "track_id").agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count("*").alias("detections"), F.count("*").alias("frames"), F.lit(0.9).alias("mean_score"), F.lit(0.1).alias("motion"))
    return {
        "videos": videos,
        "shots": videos.select("video_id", F.lit(1).alias("index"), F.lit(0.0).alias("start"), F.col("duration").alias("end")),
        "tracked": seen,
        "tracks": track,
        "identities": track.select("video_id", F.lit("F001").alias("face"), F.array("track_id").alias("track_ids")),
        "samples": t.where("speaker = 'click'").select("video_id", F.lit(1).alias("track_id"), F.col("start").alias("t"), ((F.col("event_id") % 10) / 10.0 + 0.0013).alias("p")),
        "turns": t.where("speaker not in ('view', 'click')").select("video_id", "speaker", "start", "end"),
    }


CONFIG = {
    "s8-asr": {"models": {"transcriber": lambda: models.echo}},
    "s9-paralinguistic": {"models": {"tagger": lambda: models.moods}},
    "s10-caption": {"models": {"captioner": lambda: models.plain_caption}},
}

RUN = f"""t AS (SELECT user_id AS video_id, event_type AS speaker, event_id, (epoch_us(ts) - {FROM}) / 3600000000.0::DOUBLE AS s, (epoch_us(ts) + CAST(round(value * 100) AS BIGINT) * 3600000 - {FROM}) / 3600000000.0::DOUBLE AS e FROM events),
g AS (SELECT video_id, s, lead(s) OVER (PARTITION BY video_id ORDER BY s) - s AS gap FROM t WHERE speaker = 'view'),
vis AS (SELECT video_id, min(s) AS s, max(s) + CASE WHEN count(gap) > 0 THEN list_sort(list(gap) FILTER (gap IS NOT NULL))[count(gap) // 2 + 1] ELSE 0.1 END AS e FROM g GROUP BY video_id),
tu AS (SELECT video_id, speaker, s, e FROM t WHERE speaker NOT IN ('view', 'click')), pos AS (SELECT * FROM tu WHERE e > s), {islands_sql("own", "pos", "video_id, speaker")},
sp AS (SELECT video_id, speaker, sum(e - s) AS speech FROM own GROUP BY ALL),
cv AS (SELECT own.video_id, speaker, sum(least(vis.e, own.e) - greatest(vis.s, own.s)) AS seen FROM own JOIN vis ON vis.video_id = own.video_id AND vis.s < own.e AND own.s < vis.e GROUP BY ALL),
mk AS (SELECT sp.video_id, sp.speaker, (c.event_id % 10) / 10.0 + 0.0013::DOUBLE AS p, EXISTS (SELECT 1 FROM own WHERE own.video_id = sp.video_id AND own.speaker = sp.speaker AND own.s <= c.s AND c.s < own.e) AS inside FROM sp JOIN t c ON c.video_id = sp.video_id AND c.speaker = 'click'),
sc AS (SELECT video_id, speaker, avg(p) FILTER (inside) - 0.5 * coalesce(avg(p) FILTER (NOT inside), 0) AS score FROM mk GROUP BY ALL),
on_ AS (SELECT sp.video_id, sp.speaker FROM sp JOIN cv ON cv.video_id = sp.video_id AND cv.speaker = sp.speaker JOIN sc ON sc.video_id = sp.video_id AND sc.speaker = sp.speaker WHERE seen / speech >= 0.25 AND score >= 0.05),
mine AS (SELECT tu.video_id, s, e FROM tu JOIN on_ ON on_.video_id = tu.video_id AND on_.speaker = tu.speaker), {islands_sql("a", "mine", "video_id", 0)}, {islands_sql("said", "mine", "video_id").replace("> 0 THEN", "> 0.5 THEN")},
{islands_sql("j", "said", "video_id").replace("> 0 THEN", "> 0.2 THEN")}, pad AS (SELECT video_id, greatest(s - 0.05::DOUBLE, 0) AS s, least(e + 0.05::DOUBLE, {UNTIL}::DOUBLE) AS e FROM j), {islands_sql("z", "pad", "video_id")},
sg AS (SELECT video_id, s, e, printf('F001_%04d', row_number() OVER (PARTITION BY video_id ORDER BY s, e) - 1) AS name FROM z WHERE e - s >= 0.3::DOUBLE),
ln AS (SELECT video_id, count(*) AS n, sum(e - s) AS seconds, string_agg('<F001> ' || CASE WHEN e - s < 0.5::DOUBLE THEN '' WHEN CAST(right(name, 1) AS INTEGER) < 5 THEN 'laughter: ' ELSE 'sad: ' END || '<S>' || name || '<E>', chr(10) ORDER BY s, e) AS x FROM sg GROUP BY video_id)"""


@query(
    out_sql(
        RUN,
        f"""SELECT v.video_id, (SELECT count(*) FROM on_ WHERE on_.video_id = v.video_id) AS assigned, coalesce(n, 0) AS utterances, round(coalesce(seconds, 0), 3) AS seconds,
'[GLOBAL]' || chr(10) || chr(10) || '[SHOT 1 0.0s-{UNTIL}s]' || chr(10) || CASE WHEN least(vis.e, {UNTIL}) - vis.s >= 0.2 THEN 'Shot 1 shows F001.' ELSE 'Shot 1 shows.' END || coalesce(chr(10) || x, '') || chr(10) AS script, n IS NULL OR n >= 0 AS complete
FROM (SELECT DISTINCT video_id FROM t) v LEFT JOIN vis USING (video_id) LEFT JOIN ln USING (video_id)""",
    )
)
def q_stages(spark, d):
    """Association to composition; every stage has a reason to run, and records that it did."""
    made, records = stages.run_stages(corpus(spark, d), LATE, CONFIG, store=cut)
    done = records.where("status = 'ok'").groupBy("video_id").agg((F.countDistinct("stage") >= 3).alias("complete"))
    on = made["assignments"].groupBy("video_id").agg(F.count_if(F.col("face") != "F000").alias("assigned"))
    found = made["metrics"].select("video_id", F.col("utterance_count").alias("utterances"), F.round("speech_seconds", 3).alias("seconds"))
    out = found.join(made["scripts"], "video_id").join(unsent(on), "video_id", "left").join(unsent(done), "video_id", "left").na.fill(0, ["assigned"])
    return out.select("video_id", "assigned", "utterances", "seconds", "script", F.coalesce("complete", F.lit(False)).alias("complete"))
