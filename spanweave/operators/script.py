"""The annotation script: rendered from tables, parsed back, and checked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import tag, unrenderable, utterance_line
from .intervals import KEYS, apart
from .joins import as_of

#: The grammar of an utterance and of a shot's header.
UTTERANCE = r"<F(\d+)>\s*([\w-]+)?:?\s*<S>(.*?)(?:<\s*/\s*S\s*>|<\s*E\s*>)"
HEADER = r"(?U)^\[SHOT\s+(\d+)\s+([0-9.]+)s-([0-9.]+)s\]$"
#: White space at either end, as Python strips it.
EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
#: Everything that Python's splitlines ends a line at.
LINE_ENDS = "\r\n|[" + "".join(map(chr, (0x0A, 0x0D, 0x0B, 0x0C, 0x1C, 0x1D, 0x1E, 0x85, 0x2028, 0x2029))) + "]"


def lines(utterances: DataFrame) -> DataFrame:
    """Utterances (``face, tag, text``) with their ``line``, or the ``problem`` that keeps them out."""
    label = tag(F.col("tag"))
    problem = unrenderable(F.col("text"), label)
    return utterances.withColumn("problem", problem).withColumn("line", F.when(problem.isNull(), utterance_line(F.col("face"), label, F.col("text"))))


def to_shots(utterances: DataFrame, shots: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Utterances with the ``shot`` that they begin in: the last one starting by then, else the first.

    Shots count in the order of their index up to the first that starts later than the utterance.
    """
    order = W.partitionBy(*keys).orderBy("index").rowsBetween(W.unboundedPreceding, 0)
    by_then = shots.select(*keys, "index", F.max("start").over(order).alias("__from"))
    begun = by_then.select(*keys, F.col("__from").alias("t"), F.col("index").alias("shot"))
    return as_of(utterances.withColumn("t", F.col("start")), begun, "shot", keys, first_if_none=True).where("shot is not null").drop("t")


def render(videos: DataFrame, shots: DataFrame, utterances: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One ``script`` text for each video: global caption, then each shot's header, caption and lines."""
    placed = to_shots(lines(utterances).where("problem is null"), shots, keys)
    said = placed.groupBy(*keys, F.col("shot").alias("index")).agg(F.array_sort(F.collect_list(F.struct("start", "end", "face", "line"))).alias("__l"))
    head = F.format_string("[SHOT %d %ss-%ss]", "index", F.bround(F.col("start").cast("double"), 1).cast("decimal(20,1)"), F.bround(F.col("end").cast("double"), 1).cast("decimal(20,1)"))
    caption = F.when(F.trim(F.coalesce("caption", F.lit(""))) != "", F.array(F.trim("caption"))).otherwise(F.array().cast("array<string>"))
    block = F.array_join(F.concat(F.array(head), caption, F.coalesce(F.transform("__l", lambda x: x["line"]), F.array().cast("array<string>"))), "\n")
    blocks = shots.join(said, [*keys, "index"], "left").select(*keys, "index", block.alias("__b"))
    body = blocks.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("index", "__b"))), lambda x: x["__b"]), "\n\n").alias("__body"))
    intro = F.concat_ws("\n", F.lit("[GLOBAL]"), F.nullif(F.trim("caption"), F.lit("")))
    return videos.select(*keys, intro.alias("__intro")).join(body, list(keys), "left").select(*keys, F.concat(F.concat_ws("\n\n", "__intro", "__body"), F.lit("\n")).alias("script"))


def render_flat(videos: DataFrame, utterances: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One paragraph for each video: the global caption, then all lines in order, joined by ``", "``."""
    said = lines(utterances).where("problem is null").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("start", "end", "face", "line"))).alias("__l"))
    intro = F.when(F.trim(F.coalesce("caption", F.lit(""))) != "", F.array(F.trim("caption"))).otherwise(F.array().cast("array<string>"))
    spoken = F.coalesce(F.transform("__l", lambda x: x["line"]), F.array().cast("array<string>"))
    return videos.join(said, list(keys), "left").select(*keys, F.concat(F.array_join(F.concat(intro, spoken), ", "), F.lit("\n")).alias("script"))


def read_lines(scripts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Lines of each script that hold anything: ``line`` from 0, ``block`` (how many shot headers came by
    then), ``shot, start, end`` of the last header, ``said`` (the utterances) and ``prose`` (the rest).

    Prose before the first header counts only after the global one.  A line that does not match the
    grammar is prose.
    """
    split = scripts.select(*keys, F.posexplode(F.split("script", LINE_ENDS)).alias("line", "__text")).withColumn("__text", F.regexp_replace("__text", EDGES, ""))
    order = W.partitionBy(*keys).orderBy("line").rowsBetween(W.unboundedPreceding, 0)
    part = lambda n: F.nullif(F.regexp_extract("__text", HEADER, n), F.lit(""))
    head = F.when(part(1).isNotNull(), F.struct(part(1).cast("int").alias("shot"), part(2).try_cast("double").alias("start"), part(3).try_cast("double").alias("end")))
    located = split.where("__text <> ''").withColumns({"__head": head, "__global": F.col("__text") == "[GLOBAL]"})
    located = located.withColumns({"__last": F.last("__head", ignorenulls=True).over(order), "block": F.count("__head").over(order), "__after": F.max("__global").over(order)})
    every = F.arrays_zip(*[F.regexp_extract_all("__text", F.lit("(?U)" + UTTERANCE), F.lit(i)).alias(c) for i, c in enumerate(("n", "tag", "text"), 1)])
    said = F.transform(every, lambda u: F.struct(F.format_string("F%03d", u["n"].cast("int")).alias("face"), F.nullif(F.lower(u["tag"]), F.lit("")).alias("tag"), F.regexp_replace(u["text"], EDGES, "").alias("text")))
    gaps = F.transform(F.split("__text", "(?U)" + UTTERANCE, -1), lambda g: F.regexp_replace(g, "^[ ,]+|[ ,]+$", ""))
    prose = F.nullif(F.array_join(F.filter(gaps, lambda g: g != ""), " "), F.lit(""))
    own = F.col("__head").isNull() & ~F.col("__global")
    counts = own & ((F.col("block") > 0) | F.col("__after"))
    none = F.array().cast("array<struct<face:string,tag:string,text:string>>")
    return located.select(*keys, "line", "block", "__last.shot", "__last.start", "__last.end", F.when(own, said).otherwise(none).alias("said"), F.when(counts, prose).alias("prose"))


def parse(scripts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Utterances of each script: ``position`` from 0, ``shot`` (null before any), ``face, tag, text``.

    Those before the first shot come first, as they stand.
    """
    found = read_lines(scripts, keys).select(*keys, "shot", "line", F.posexplode("said").alias("__at", "u"))
    place = W.partitionBy(*keys).orderBy("line", "__at")
    return found.select(*keys, (F.row_number().over(place) - 1).alias("position"), "shot", "u.face", "u.tag", "u.text")


def parse_blocks(scripts: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Blocks of each script: ``block`` (0: the global one, then shots as they stand), ``shot, start, end,
    caption`` (prose lines joined by a space) and how many ``utterances`` it has.
    """
    per = read_lines(scripts, keys).groupBy(*keys, "block").agg(
        F.first("shot").alias("shot"), F.first("start").alias("start"), F.first("end").alias("end"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("prose").isNotNull(), F.struct("line", "prose")))), lambda x: x["prose"]), " ").alias("caption"),
        F.sum(F.size("said")).alias("utterances"),
    )
    whole = scripts.select(*keys).distinct().withColumn("block", F.lit(0).cast("long"))
    return apart(whole).unionByName(apart(per), allowMissingColumns=True).groupBy(*keys, "block").agg(
        F.max("shot").alias("shot"), F.max("start").alias("start"), F.max("end").alias("end"), F.coalesce(F.max("caption"), F.lit("")).alias("caption"), F.coalesce(F.sum("utterances"), F.lit(0)).alias("utterances")
    )
