"""Queries on tags, scripts, documents, checks, composition and reports; ``catalog`` imports them.

They stand beside the catalog's others and use its tables; each has the SQL that gives its result.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import LINE, RENDERABLE, SAID, SCORES, WORDS, islands_sql, label_scores, out_sql, query, said, scenes, some_words, table
from .operators import captions as P
from .operators import qa as Q
from .operators import script as G
from .operators import tags as T

# --- tags


@query(
    out_sql(
        f"""{SCORES}, good AS (SELECT s.video_id, s.name, s.dimension, w.tag, s.label, s.score FROM scores s JOIN {WORDS.replace(" AS words", " AS w")} ON s.dimension = w.dimension AND s.label = w.label WHERE w.tag <> 'neutral' AND s.score >= 0.5),
best AS (SELECT *, CASE dimension WHEN 'event' THEN 1 WHEN 'delivery' THEN 2 ELSE 3 END AS d FROM good QUALIFY row_number() OVER (PARTITION BY video_id, name, dimension ORDER BY score DESC, tag, label) = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY video_id, name ORDER BY d) AS r FROM best),
o AS (SELECT video_id, name, max(score) AS other, count(*) AS others, arg_max(dimension, score * 100 - r / 10.0) AS rival FROM n WHERE r > 1 GROUP BY ALL),
k AS (SELECT DISTINCT video_id, name FROM scores)""",
        """SELECT k.video_id, k.name, tag, n.dimension, round(score, 4) AS score, round(CASE WHEN other IS NULL THEN score ELSE score - other END, 4) AS margin, CASE WHEN n.tag IS NULL THEN 0 ELSE 1 + coalesce(others, 0) END AS candidates,
CASE WHEN n.tag IS NULL THEN 'no dimension scored a known label above its threshold' WHEN other IS NULL OR round(score - other, 4) >= 0.1 THEN n.dimension || ' takes precedence'
  WHEN score < other THEN n.dimension || ' takes precedence over a higher-scoring ' || rival ELSE n.dimension || ' takes precedence over a close ' || rival END AS reason
FROM k LEFT JOIN n ON n.video_id = k.video_id AND n.name = k.name AND n.r = 1 LEFT JOIN o ON o.video_id = k.video_id AND o.name = k.name""",
    )
)
def q_tag_reduce(spark, d):
    scores = label_scores(spark, d)
    found = T.reduce_tags(scores, some_words(spark), ["video_id", "name"], close=0.1 - 1e-9, every=scores.select("video_id", "name").distinct())
    return found.select("video_id", "name", "tag", "dimension", F.round("score", 4).alias("score"), F.round("margin", 4).alias("margin"), "candidates", "reason")


#: Labels as models give them.
LABELS = ("Laughter", "Speech", "Giggle", "Monotone", "neutral", "Quiet", "Brand new!", "Music", "Sob", "None", "开心/happy", "Zither")


@query(
    out_sql(
        f"""l AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{x}')" for i, x in enumerate(LABELS))}) AS l(i, label)),
s AS (SELECT CASE event_id % 3 WHEN 0 THEN 'event' WHEN 1 THEN 'delivery' ELSE 'emotion' END AS dimension, l.label, (event_id % 100) / 100.0 AS score FROM events JOIN l ON l.i = (event_id // 3) % {len(LABELS)}),
news AS (SELECT * FROM (VALUES ('event', 'Monotone', 'monotone'), ('event', 'Quiet', 'quiet'), ('event', 'Brand new!', 'brand-new'), ('event', '开心/happy', '开心-happy'), ('event', 'Zither', 'zither'),
  ('delivery', 'Laughter', 'laughter'), ('delivery', 'Speech', 'speech'), ('delivery', 'Giggle', 'giggle'), ('delivery', 'Brand new!', 'brand-new'), ('delivery', 'Music', 'music'), ('delivery', 'Sob', 'sob'),
  ('delivery', '开心/happy', '开心-happy'), ('delivery', 'Zither', 'zither'), ('emotion', 'Laughter', 'laughter'), ('emotion', 'Speech', 'speech'), ('emotion', 'Giggle', 'giggle'), ('emotion', 'Monotone', 'monotone'),
  ('emotion', 'Quiet', 'quiet'), ('emotion', 'Brand new!', 'brand-new'), ('emotion', 'Music', 'music'), ('emotion', 'Sob', 'sob'), ('emotion', 'Zither', 'zither')) AS n(dimension, label, slug))""",
        "SELECT s.dimension, slug AS label, count(*) AS n FROM s JOIN news ON news.dimension = s.dimension AND news.label = s.label WHERE score >= CASE s.dimension WHEN 'event' THEN 0.3 WHEN 'delivery' THEN 0.7 ELSE 0.5 END GROUP BY ALL",
    )
)
def q_unmapped(spark, d):
    label = F.get(F.array(*[F.lit(x) for x in LABELS]), F.floor(F.col("event_id") / 3).cast("int") % len(LABELS))
    return T.unmapped(label_scores(spark, d, label), T.vocabulary(spark), least={"event": 0.3, "delivery": 0.7})


@query(
    out_sql(
        SCORES,
        """SELECT video_id, name, dimension, label, round(score, 4) AS score, CAST(rank AS BIGINT) AS rank FROM (SELECT s.*, row_number() OVER (PARTITION BY video_id, name, dimension ORDER BY score DESC, label) AS rank
FROM (SELECT video_id, name, dimension, label, max(score) AS score FROM scores GROUP BY ALL) s) WHERE rank <= 2""",
    )
)
def q_top_labels(spark, d):
    once = label_scores(spark, d).groupBy("video_id", "name", "dimension", "label").agg(F.max("score").alias("score")).withColumn("position", F.col("label"))
    return T.top_labels(once, ["video_id", "name"], 2).select("video_id", "name", "dimension", "label", F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))


# --- scripts and their checks

#: A fault of a text that the round trip would change: white space at its ends, or a line end that rendering lets through.
CHANGED = r"(text <> trim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(32) || chr(133) || chr(160)) OR regexp_matches(text, '[\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]'))"
SPOKEN = f"""{SAID}, o AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY s, e, face) - 1 AS n, lag(e) OVER (PARTITION BY video_id, face ORDER BY s, e) AS p FROM u),
v AS (SELECT video_id, max(e) - 5 AS duration, CASE WHEN video_id % 5 <> 0 THEN sum(e - s) - CASE WHEN video_id % 2 = 0 THEN 4 ELSE 0 END END AS voiced, count(*) AS k, sum(e - s) AS said FROM u GROUP BY video_id)"""
AT = "printf('%s utterance at %.2fs ', face, s::DOUBLE)"


@query(
    out_sql(
        rf"""{SPOKEN}, h AS (SELECT video_id, count(*) AS n, arg_min({AT} || CASE WHEN coalesce(trim(text), '') = '' THEN 'has empty text' WHEN contains(text, '<') THEN 'contains ''<''' WHEN contains(text, '>') THEN 'contains ''>'''
  WHEN contains(text, chr(10)) THEN 'contains ''\n''' ELSE 'contains ''\r''' END, n) AS d FROM o WHERE NOT ({RENDERABLE}) GROUP BY video_id),
i AS (SELECT video_id, count(*) AS n FROM o WHERE face = 'F002' AND video_id % 3 <> 0 GROUP BY video_id),
r AS (SELECT o.video_id, count(*) FILTER (o.e > duration + 1e-6 OR o.s < o.p - 1e-6) AS n,
  arg_min(printf('%s utterance [%.3f, %.3f] falls outside the video''s %.3fs by %.6fs', face, o.s::DOUBLE, o.e::DOUBLE, duration::DOUBLE, (o.e - duration)::DOUBLE), o.n) FILTER (o.e > duration + 1e-6) AS d,
  arg_min(printf('%s has overlapping utterances at %.2fs (previous ended %.2fs)', face, o.s::DOUBLE, o.p::DOUBLE), (face, o.n)) FILTER (o.s < o.p - 1e-6) AS d2 FROM o JOIN v USING (video_id) GROUP BY o.video_id),
t AS (SELECT video_id, count(*) FILTER ({CHANGED} AND {RENDERABLE}) AS c, min(n) FILTER ({CHANGED} AND {RENDERABLE}) AS a FROM o GROUP BY video_id)""",
        """SELECT video_id, 0 AS position, 'format_hygiene' AS gate, coalesce(n, 0) = 0 AS passed, coalesce(d, k || ' utterances are renderable') AS detail FROM v LEFT JOIN h USING (video_id)
UNION ALL SELECT video_id, 1, 'id_integrity', n IS NULL, CASE WHEN n > 0 THEN 'utterance references F002, which has no face track' WHEN video_id % 3 = 0 THEN '0 face ids, all referenced ids resolve' ELSE '1 face ids, all referenced ids resolve' END FROM v LEFT JOIN i USING (video_id)
UNION ALL SELECT video_id, 2, 'timeline_sanity', n = 0, coalesce(d, d2, k || ' spans are ordered and in range') FROM v JOIN r USING (video_id)
UNION ALL SELECT video_id, 3, 'speech_accounting', NOT coalesce(abs(said - voiced) > 1.5, false), CASE WHEN voiced IS NULL THEN 'no VAD total supplied; accounting not checked'
  ELSE printf('attributed %.2fs against VAD %.2fs', said::DOUBLE, voiced::DOUBLE) || CASE WHEN abs(said - voiced) > 1.5 THEN printf(' (off by %+.2fs, tolerance 1.50s)', (said - voiced)::DOUBLE) ELSE '' END END FROM v
UNION ALL SELECT v.video_id, 4, 'render_round_trip', h.n IS NULL AND t.c = 0, CASE WHEN h.n > 0 THEN 'rendering failed' WHEN t.c > 0 THEN printf('utterance %d changed on round trip', t.a) ELSE k || ' utterances round-tripped exactly' END
  FROM v JOIN t USING (video_id) LEFT JOIN h USING (video_id)""",
    )
)
def q_gates(spark, d):
    u = said(spark, d)
    length = F.col("end") - F.col("start")
    voiced = F.when(F.col("video_id") % 5 != 0, F.col("v") - F.when(F.col("video_id") % 2 == 0, 4).otherwise(0))
    spans = u.groupBy("video_id").agg((F.max("end") - 5).alias("duration"), F.sum(length).alias("v")).withColumn("voiced", voiced)
    tracks = u.where("video_id % 3 <> 0").select("video_id").distinct().withColumn("face", F.lit("F001"))
    videos, shots = scenes(spark, d)
    found = Q.gates(u, tracks, spans.select("video_id", "duration", "voiced"), scripts=G.render(videos.select("video_id", "caption"), shots, u))
    return found.select("video_id", "position", "gate", "passed", F.when(F.col("detail").startswith("rendering failed"), "rendering failed").otherwise(F.col("detail")).alias("detail"))


@query(
    out_sql(
        f"""{SAID}, v AS (SELECT video_id, max(e) AS duration, count(*) AS utterance_count, CAST(coalesce(sum(e - s) FILTER (face <> 'F000'), 0) AS BIGINT) AS face_speech_seconds, CAST(coalesce(sum(e - s) FILTER (face = 'F000'), 0) AS BIGINT) AS offscreen_speech_seconds,
  CAST(sum(e - s) AS BIGINT) AS speech_seconds, round(avg(e - s), 6) AS mean_utterance_seconds, max(e - s) AS max_utterance_seconds, count(*) FILTER (turn % 4 = 1) AS short_utterance_count, count(tag) AS tagged_utterance_count,
  count(*) FILTER (coalesce(trim(text), '') = '') AS empty_text_count FROM u GROUP BY video_id),
f AS (SELECT video_id, count(DISTINCT face) AS face_count, count(DISTINCT face) FILTER (face = 'F001') AS speaking_face_count FROM u WHERE face <> 'F000' GROUP BY video_id),
{islands_sql("w", "u", "video_id")}, l AS (SELECT video_id, CAST(sum(e - s) AS BIGINT) AS utterance_union_seconds FROM w GROUP BY video_id),
{islands_sql("o", "u", "video_id, face")}, ev AS (SELECT video_id, t, sum(x) AS x FROM (SELECT video_id, s AS t, 1 AS x FROM o UNION ALL SELECT video_id, e, -1 FROM o) GROUP BY video_id, t),
sw AS (SELECT video_id, t AS s, lead(t) OVER w AS e, sum(x) OVER w AS n FROM ev WINDOW w AS (PARTITION BY video_id ORDER BY t)),
x AS (SELECT video_id, CAST(sum(e - s) AS BIGINT) AS overlap_seconds FROM sw WHERE n >= 2 AND e IS NOT NULL GROUP BY video_id)""",
        """SELECT v.* EXCLUDE (duration), coalesce(face_count, 0) AS face_count, coalesce(speaking_face_count, 0) AS speaking_face_count, utterance_union_seconds, coalesce(overlap_seconds, 0) AS overlap_seconds, round(speech_seconds / duration, 6) AS speech_ratio,
round(face_speech_seconds / speech_seconds, 6) AS assigned_ratio, round(coalesce(overlap_seconds, 0) / utterance_union_seconds, 6) AS overlap_ratio FROM v LEFT JOIN f USING (video_id) LEFT JOIN l USING (video_id) LEFT JOIN x USING (video_id)""",
    )
)
def q_metrics(spark, d):
    u = said(spark, d).withColumn("flags", F.when(F.col("row_id") % 4 == 1, F.array(F.lit("short"))).otherwise(F.array().cast("array<string>")))
    tracks = u.where("face <> 'F000'").select("video_id", "face").distinct().withColumn("speaks", F.col("face") == "F001")
    found = Q.metrics(u, tracks, u.groupBy("video_id").agg(F.max("end").alias("duration")))
    return found.withColumns({c: F.round(c, 6) for c in ("speech_ratio", "assigned_ratio", "overlap_ratio", "mean_utterance_seconds")})


@query(
    out_sql(
        f"""{SAID}, l AS (SELECT video_id, string_agg({LINE}, ', ' ORDER BY s, e, face, {LINE}) AS x FROM u WHERE {RENDERABLE} GROUP BY video_id)""",
        "SELECT video_id, 'A talk.' || coalesce(', ' || x, '') || chr(10) AS script FROM (SELECT DISTINCT video_id FROM u) LEFT JOIN l USING (video_id)",
    )
)
def q_flat(spark, d):
    return G.render_flat(scenes(spark, d)[0].select("video_id", "caption"), said(spark, d))


SHOWN = f"""{SAID}, v AS (SELECT video_id, max(e) AS d FROM u GROUP BY video_id), b AS (SELECT DISTINCT u.video_id, s AS t FROM u JOIN v USING (video_id) WHERE turn % 2 = 1 AND s > 0 AND s < d UNION SELECT video_id, 0 FROM v UNION SELECT video_id, d FROM v),
sh AS (SELECT * FROM (SELECT video_id, row_number() OVER w AS i, t AS s, lead(t) OVER w AS e FROM b WINDOW w AS (PARTITION BY video_id ORDER BY t)) WHERE e IS NOT NULL)"""


@query(
    out_sql(
        f"""{SHOWN}, l AS (SELECT u.video_id, (SELECT max(i) FROM sh WHERE sh.video_id = u.video_id AND sh.s <= u.s) AS i, count(*) AS n FROM u WHERE {RENDERABLE} GROUP BY ALL)""",
        """SELECT video_id, CAST(0 AS BIGINT) AS block, NULL AS shot, NULL AS "start", NULL AS "end", 'A talk.' AS caption, CAST(0 AS BIGINT) AS utterances FROM v
UNION ALL SELECT sh.video_id, i, CAST(i AS INTEGER), s::DOUBLE, e::DOUBLE, 'Two people.', coalesce(n, 0) FROM sh LEFT JOIN l USING (video_id, i)""",
    )
)
def q_parse_blocks(spark, d):
    videos, shots = scenes(spark, d)
    return G.parse_blocks(G.render(videos.select("video_id", "caption"), shots, said(spark, d)))


# --- boxes


@query(
    """WITH p AS (SELECT p_partkey, (p_partkey * 37 % 70001) / 97.0::DOUBLE - 20 AS x, (p_partkey * 53 % 50021) / 101.0::DOUBLE - 10 AS y, (p_partkey * 13 % 9007) / 89.0::DOUBLE - 5 AS w, (p_partkey * 17 % 9001) / 83.0::DOUBLE - 3 AS h FROM part),
b AS (SELECT *, round_even(x - w * 0.4::DOUBLE, 0) AS bx, round_even(y - h * 0.4::DOUBLE, 0) AS "by", round_even(w + 0.8::DOUBLE * w, 0) AS bw, round_even(h + 0.8::DOUBLE * h, 0) AS bh FROM p),
c AS (SELECT *, greatest(0, least(bx, 640)) AS l, greatest(0, least("by", 480)) AS t FROM b)
SELECT p_partkey, CAST(CASE WHEN w <= 0 OR h <= 0 THEN trunc(x) ELSE l END AS INTEGER) AS x, CAST(CASE WHEN w <= 0 OR h <= 0 THEN trunc(y) ELSE t END AS INTEGER) AS y,
CAST(CASE WHEN w <= 0 OR h <= 0 THEN 0 ELSE greatest(l, least(bx + bw, 640)) - l END AS INTEGER) AS width, CAST(CASE WHEN w <= 0 OR h <= 0 THEN 0 ELSE greatest(t, least("by" + bh, 480)) - t END AS INTEGER) AS height FROM c"""
)
def q_crop_box(spark, d):
    part = lambda a, m, n, less: F.col("p_partkey") * a % m / float(n) - less
    x, y, w, h = part(37, 70001, 97, 20), part(53, 50021, 101, 10), part(13, 9007, 89, 5), part(17, 9001, 83, 3)
    box = P.crop_box(x, y, w, h, F.lit(640), F.lit(480), margin=0.4)
    return table(spark, d, "part").select("p_partkey", *[v.alias(k) for k, v in box.items()])
