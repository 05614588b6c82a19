"""SpotSigs document fingerprints, in DataFrame and SQL functions alone.

Common words are anchors.  An anchor with the chain of the CHAIN content words that follow it,
other common words skipped, is one signature; a text's fingerprint is the set of its signatures,
hashed.  Signatures sit where running prose is, so menus and tables hardly touch them.  Sets are
compared by Jaccard.  Only sets of near lengths can be alike as a threshold says, so the search for
similar texts partitions sets by length and joins neighbouring partitions alone, on the rarest
signatures, of which similar sets share at least one.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanweave.operators.intervals import apart

from .common import cut, n_partitions, table, text_of

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with "
    "als auf aus bei das dem den der des die ein eine im ist mit nicht sich und von zu für "
    "au aux avec ce dans du elle est et la le les mais ou par pas pour que qui sur un une "
    "con de del el en es las lo los no para por se su una y"
).split()
CHAIN = 2
LIKE = 0.8
GLUE = "\x01"
#: What names a text in the order of documents: whether its id is null, its id with all
#: bits flipped (so that it falls as the id grows), its hash.
KEY = ("no_id", "e", "h")
#: Rows alike in id and text beyond which they are made one before texts are shuffled.
ALIKE = 10_000


def with_signatures(df: DataFrame, text: str, out: str, chain: int = CHAIN) -> DataFrame:
    """``df`` with ``out``, the sorted set of signatures (64-bit hashes) of the column ``text``.

    A text without any signature has the hash of all its words as its only one, so texts without
    common words are alike only if their words are equal; a text without words has the empty set.
    Steps are columns of their own so that none is evaluated twice.
    """
    words, tokens, content, signs = (f"__sw_{x}" for x in ("words", "tokens", "content", "signs"))
    plain = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    # Common words are glued to the content word that follows: "the house" is one token, the|house.
    glued = F.array_join(F.transform(F.split(words, " "), lambda w: F.concat(w, F.when(w.isin(ANCHORS), GLUE).otherwise(" "))), "")

    def signed(token: Column, i: Column) -> Column:
        follow = F.array_join(F.slice(F.col(content), i + 1, chain), " ")
        anchors = F.array_distinct(F.split(F.call_function("substring_index", token, F.lit(GLUE), F.size(F.split(token, GLUE)) - 1), GLUE))
        return F.when(F.instr(token, GLUE) > 0, F.transform(anchors, lambda a: F.xxhash64(a, follow))).otherwise(F.array().cast("array<long>"))

    whole = F.filter(F.col(content), lambda c: c != "")
    df = df.withColumn(words, plain).withColumn(tokens, F.split(F.rtrim(glued), " "))
    df = df.withColumn(content, F.transform(tokens, lambda t: F.substring_index(t, GLUE, -1))).withColumn(content, whole)
    # A chain that runs off the end of the text is no signature.
    spots = F.transform(F.slice(F.col(tokens), 1, F.greatest(F.size(content) - (chain - 1), F.lit(0))), signed)
    df = df.withColumn(signs, F.sort_array(F.array_distinct(F.flatten(spots))))
    none = F.when(F.col(words) == "", F.array().cast("array<long>")).otherwise(F.array(F.xxhash64(words)))
    return df.withColumn(out, F.when(F.size(signs) > 0, F.col(signs)).otherwise(none)).drop(words, tokens, content, signs)


def fingerprint(signs: str) -> Column:
    """The set written out, sixteen hex digits for each signature, in order."""
    return F.array_join(F.transform(signs, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def jaccard(a: str, b: str) -> Column:
    """Share of two sets' union that is in both; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def _range_of(bounds: list[tuple]) -> Column:
    """How many of the sorted keys ``bounds`` are not above the row's KEY, by binary search."""
    if not bounds:
        return F.lit(0)
    listed = json.dumps([dict(zip(KEY, b, strict=True)) for b in bounds])
    known = F.from_json(F.lit(listed), "array<struct<no_id:boolean,e:bigint,h:bigint>>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(bounds).bit_length()))])
    reached = lambda p, step: (p + step <= len(bounds)) & (F.get(known, p + step - 1) <= F.struct(*KEY))
    return F.aggregate(steps, F.lit(0), lambda p, step: F.when(reached(p, step), p + step).otherwise(p))


def with_next(docs: DataFrame) -> DataFrame:
    """``doc_id, text, signs, next, copies``: each distinct (doc_id, text) with its signatures and
    ``next`` (text, signs), those of the one after it; ``copies`` is how many rows it stands for.

    The order is that of descending doc_id (nulls last), ties by text hash, and closes to a ring:
    after the last comes the first.  Ids and hashes alone are ordered first, in ranges.  Then texts
    are shuffled once, by range, with the first text of the range that follows each; so every text
    stands beside its next.  Ranges are four for each partition, and the driver gets their first keys.
    Rows alike in id and text that are more than ALIKE are made one before that shuffle.
    """
    spark = docs.sparkSession
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.isNull().alias("no_id"), F.bitwise_not(F.coalesce(doc_id, F.lit(0))).alias("e"), F.xxhash64(text_of()).alias("h"), text_of().alias("text"))
    each = cut(rows.groupBy(*KEY).agg(F.count("*").alias("n")))
    ranged = each.repartitionByRange(4 * n_partitions(spark), *KEY).groupBy(F.spark_partition_id().alias("range")).agg(F.min(F.struct(*KEY)).alias("first"))
    firsts = sorted(tuple(r["first"]) for r in ranged.collect())
    # As many rows as ranges: broadcast.
    heads = F.broadcast(spark.createDataFrame([(*key, (i - 1) % len(firsts)) for i, key in enumerate(firsts)], "no_id boolean, e long, h long, range int"))
    ahead = rows.join(heads, list(KEY)).groupBy("range", *KEY).agg(F.first("text").alias("text")).select("range", F.lit(True).alias("ahead"), *KEY, "text", F.lit(0).cast("long").alias("n"))
    many = each.where(F.col("n") > ALIKE).select(*KEY)
    own = rows.withColumn("n", F.lit(1).cast("long"))
    if not many.isEmpty():
        alike = rows.join(many, list(KEY), "left_semi").groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("n"))
        own = apart(own.join(many, list(KEY), "left_anti")).unionByName(apart(alike))
    own = own.select(_range_of(firsts[1:]).alias("range"), F.lit(False).alias("ahead"), *KEY, "text", "n")
    dealt = own.union(ahead).repartition(n_partitions(spark), "range")
    once = dealt.groupBy("range", "ahead", *KEY).agg(F.first("text").alias("text"), F.sum("n").alias("copies"))
    order = W.partitionBy("range").orderBy("ahead", *KEY)
    found = with_signatures(once, "text", "signs").withColumn("next", F.lead(F.struct("text", "signs")).over(order)).where("not ahead")
    return found.select(F.when(~F.col("no_id"), F.bitwise_not("e")).alias("doc_id"), "text", "signs", "next", "copies")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of each text, of its edited text, and how alike they and the next text's are.

    The edited text has the last floor(n_chars / 2) code points of the text replaced by the first as
    many (or all) of the next document's, by descending doc_id, after the last the first.  Returns
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    Null text: as empty.  Null doc_id: after all others.  Repeated rows (doc_id and text) count
    once in the order and get equal results, a row each.  A single document is its own next.  Empty
    table: empty result.  Very long texts are signed whole.  Other columns are dropped.
    """
    both = with_next(docs).withColumn("n", F.length("text"))
    both = with_signatures(both.withColumn("edited", F.expr("concat(substring(text, 1, n - n div 2), substring(next.text, 1, n div 2))")), "edited", "edited_signs")
    both = both.withColumn("next_signs", F.col("next.signs"))
    found = both.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("signs").alias("fingerprint"),
        fingerprint("edited_signs").alias("edited_fingerprint"),
        jaccard("signs", "edited_signs").alias("near_edited"),
        jaccard("signs", "next_signs").alias("near_next"),
        "copies",
    )
    # A row for each copy, in two steps so that no list grows with their number.
    names = [c for c in found.columns if c != "copies"]
    parts = found.select(*names, "copies", F.explode(F.expr(f"sequence(0, (copies - 1) div {ALIKE})")).alias("part"))
    return parts.select(*names, F.explode(F.expr(f"array_repeat(0, cast(least({ALIKE}, copies - part * {ALIKE}) as int))")).alias("copy")).drop("copy")


def similar_texts(docs: DataFrame, threshold: float = LIKE) -> DataFrame:
    """``a, b, similarity``: pairs of distinct signature sets with Jaccard of ``threshold`` or more.

    Sets are named by their fingerprints' hash (``class_of`` gives each document's), so copies are
    one set.  A set of length n can be alike only one of length threshold*n to n/threshold: sets
    are partitioned by length, in steps of 1/threshold, and each is joined with its own partition
    and the next.  Within it, sets are joined on their rarest signatures, the fewest that a similar
    set cannot all lack, and pairs are compared once.

    Null, empty and wordless texts have the empty set and are in no pair.  Very long texts are signed
    whole.  Repeated rows and equal texts are one set.  Empty table: empty result.  Other columns are
    dropped.
    """
    # Cut before the filter, which would otherwise be pushed below the steps and repeat them.
    sets = cut(class_of(docs).select("name", "signs")).where("size(signs) > 0").dropDuplicates(["name"])
    sets = cut(sets.withColumn("part", F.floor(F.log(F.size("signs").cast("double")) / math.log(1 / threshold) + 1e-9)))
    spots = sets.select("name", "part", F.size("signs").alias("n"), F.explode("signs").alias("sign"))
    freq = spots.groupBy("sign").agg(F.count("*").alias("often"))
    ranked = spots.join(freq, "sign").groupBy("name", "part", "n").agg(F.array_sort(F.collect_list(F.struct("often", "sign"))).alias("by_rarity"))
    probe = F.expr(f"slice(by_rarity, 1, n - cast(ceil({threshold} * n - 1e-9) as int) + 1)")
    keys = ranked.select("name", "part", "n", F.explode(probe).alias("s")).select("name", "part", "n", F.col("s.sign").alias("sign"))
    left = keys.select(F.col("name").alias("a"), F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"), F.col("part").alias("own"), F.col("n").alias("n_a"), "sign")
    right = keys.select(F.col("name").alias("b"), "part", F.col("n").alias("n_b"), "sign")
    pairs = left.join(right, ["part", "sign"]).where("(own < part or a < b) and least(n_a, n_b) >= " + str(threshold) + " * greatest(n_a, n_b) - 1e-9").select("a", "b").distinct()
    with_a = pairs.join(sets.select(F.col("name").alias("a"), F.col("signs").alias("signs_a")), "a")
    full = with_a.join(sets.select(F.col("name").alias("b"), F.col("signs").alias("signs_b")), "b")
    return full.select("a", "b", jaccard("signs_a", "signs_b").alias("similarity")).where(F.col("similarity") >= threshold - 1e-9)


def class_of(docs: DataFrame) -> DataFrame:
    """``doc_id, name, signs``: each row with the name of its signature set; equal sets have one name.

    Null text: as empty, with the empty set.  Repeated rows: a row each.  Empty table: empty result.
    Other columns are dropped.
    """
    own = with_signatures(docs.select("doc_id", text_of().alias("text")), "text", "signs")
    return own.select("doc_id", F.xxhash64("signs").alias("name"), "signs")


def run(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
