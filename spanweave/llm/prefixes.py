"""The prefix trie of conversations: who shares which first turns with whom.

Each conversation's turns are digested one on another, so a prefix is one digest.  Of those that share a
prefix the smallest conv_id owns its node; a conversation that owns a depth owns all below it, so its
first owned depth is found by binary search, for all conversations at once: each round joins the
digests at the depths asked for with the table of each digest's smallest conversation.  What a
conversation owns is a chain of nodes, and the chains form a tree by where they branch off.  Sums over
chains are gathered bottom-up, by pointers that double their reach in each round, and a node's own
numbers are the sums of what branches off at or below it along its chain.

So the rounds grow with logarithms of the longest conversation and of the chains' nesting.  Texts are
read once and not shuffled: digests and lengths are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanweave.shipping import ship

from .common import BATCH_ROWS, crc32_sql, cut, forget, n_partitions, release, runs, table
from .repair import pack

#: A round of the search asks for seven depths, which is three halvings.
WAYS = 8
#: Turns that op12 takes from another conversation at most, and how many share that one.
HEAD, SHARE = 6, 100


def turn_digests(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, chars`` of each row: SHA-256 of role and text, and the text's code points.

    Null role or text: empty.  Rows without a conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))
    return rows.where("conv_id is not null")


def own_turns(found: DataFrame) -> DataFrame:
    """``turn_digests`` as parts of ``paths``: each conversation by itself."""
    root = found.select("conv_id").distinct().select("conv_id", F.lit(-1).alias("side"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("chars"))
    return root.union(found.select("conv_id", F.lit(1).alias("side"), "turn", "digest", "chars")).withColumn("skip", F.lit(0).cast("long"))


def rebuilt(found: DataFrame) -> DataFrame:
    """Parts of ``paths`` for conversations whose first h turns are those of another one.

    Conversation c takes the first h turns of c - c % 100, h being crc32 of c's decimal text mod 6, and
    then its own turns but for its first h.  Of the conversations that others take from, at most five
    turns each are joined, with a hundred conversations at most.
    """
    h = F.crc32(F.col("conv_id").cast("string")) % HEAD
    order = W.partitionBy("conv_id").orderBy("turn", "digest")
    heads = found.where(f"conv_id % {SHARE} = 0").withColumn("place", F.row_number().over(order).cast("long")).where(f"place < {HEAD}")
    heads = heads.select(F.col("conv_id").alias("base"), F.col("place").alias("turn"), "digest", "chars")
    every = found.select("conv_id").distinct().select("conv_id", h.alias("h"), F.expr(f"conv_id - conv_id % {SHARE}").alias("base"))
    taken = every.join(heads, "base").where("turn <= h").select("conv_id", F.lit(0).alias("side"), "turn", "digest", "chars", F.lit(0).cast("long").alias("skip"))
    return own_turns(found).withColumn("skip", F.when(F.col("side") == 1, h).otherwise(0)).union(taken)


PATH = "conv_id long, depth long, digest binary, chars long, upto long"


def paths(parts: DataFrame) -> DataFrame:
    """``conv_id, depth, digest, chars, upto``: each conversation's prefixes, from depth 0 on.

    ``parts`` stand by side (-1: the conversation itself), turn (nulls first) and digest; of those of side
    1 the first ``skip`` are passed over.  digest is that of all turns so far, upto their code points.
    A conversation streams through one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        out, depth, passed, total, chain = [], 0, 0, 0, b""
        for key, new, part in runs(batches):
            rows = list(zip(*(part.column(i).to_pylist() for i in range(1, 5)), strict=True))
            if new:
                depth, passed, total, chain = 0, 0, 0, b""
            for side, digest, chars, skip in rows:
                if side == 1 and passed < skip:
                    passed += 1
                    continue
                if side >= 0:
                    chain = hashlib.blake2b(chain + digest, digest_size=16).digest()
                    depth, total = depth + 1, total + chars
                out.append((key, depth, chain, chars, total))
                if len(out) >= BATCH_ROWS:
                    yield pack(out, PATH)
                    out = []
        if out:
            yield pack(out, PATH)

    spark = parts.sparkSession
    ship(spark)
    ordered = parts.repartition(n_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "side", "turn", "digest")
    return ordered.select("conv_id", "side", "digest", "chars", "skip").mapInArrow(run, PATH)


def chains(found: DataFrame) -> DataFrame:
    """One row for each conversation of ``paths``: ``conv_id, n, total, first, parent, attach, before``.

    n turns of total code points; it owns the depths first..n (none where first is n + 1) and branches
    off ``parent``'s chain at the depth attach, up to which it has ``before`` code points.  The smallest
    conversation owns the root; its parent is null.
    """
    every = cut(found.groupBy("conv_id").agg(F.max("depth").alias("n"), F.max("upto").alias("total")))
    top = every.agg(F.min("conv_id").alias("root"), F.max("n").alias("n")).first()
    owners = cut(found.where("depth > 0").groupBy("digest").agg(F.min("conv_id").alias("owner")))
    root, none = F.lit(top["root"]).cast("long"), F.lit(None).cast("long")
    is_root = F.col("conv_id") == root
    state = every.select(
        "conv_id", "n", "total", F.when(is_root, none).otherwise(root).alias("parent"), F.when(is_root, -1).otherwise(0).cast("long").alias("low"),
        F.when(is_root, 0).otherwise(F.col("n") + 1).alias("high"), F.lit(0).cast("long").alias("before"),
    )
    gap = (top["n"] or 0) + 1
    while gap > 1:
        before = state
        asked = F.filter(F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(WAYS - 1)), lambda i: F.col("low") + F.floor((F.col("high") - F.col("low")) * i / WAYS))), lambda d: d > F.col("low"))
        open_ = state.where("high - low > 1").withColumn("depth", F.explode(asked))
        met = open_.join(found.select("conv_id", "depth", "digest", "upto"), ["conv_id", "depth"]).join(owners, "digest")
        mine = F.col("owner") == F.col("conv_id")
        above = F.max(F.when(~mine, F.struct("depth", "owner", "upto")))
        stepped = met.groupBy("conv_id").agg(*(F.first(c).alias(c) for c in ("n", "total", "parent", "low", "high", "before")), above.alias("a"), F.min(F.when(mine, F.col("depth"))).alias("b"))
        stepped = stepped.select(
            "conv_id", "n", "total", F.coalesce("a.owner", "parent").alias("parent"), F.coalesce("a.depth", "low").alias("low"), F.coalesce("b", "high").alias("high"), F.coalesce("a.upto", "before").alias("before")
        )
        state = cut(state.where("high - low <= 1").union(stepped))
        forget(before)
        gap = -(-gap // WAYS)
    state = state.withColumn("parent", F.when(is_root, none).otherwise(F.col("parent")))
    return state.select("conv_id", "n", "total", F.col("high").alias("first"), "parent", F.col("low").alias("attach"), "before")


SUMS = ("members", "chars", "own", "leaves")


def subtrees(found: DataFrame) -> DataFrame:
    """``chains`` with sums over each chain and all that branch off it, however far below: conversations,
    their code points, the code points of owned nodes, leaves.

    In round k a chain adds what the chains 2^k branchings below it have gathered, and points twice as far
    up, so a tree of chains nested d deep takes log2 d rounds.
    """
    there = (F.col("n") >= F.col("first")) & F.col("parent").isNotNull()
    kids = found.where(there).select(F.col("parent").alias("conv_id"), F.col("attach").alias("n")).distinct().withColumn("kid", F.lit(1))
    leaf = F.when((F.col("n") >= F.col("first")) & F.col("kid").isNull(), 1).otherwise(0).cast("long")
    base = found.join(kids, ["conv_id", "n"], "left").withColumn("leaf", leaf).drop("kid")
    base = cut(base)
    state = base.select("conv_id", F.col("parent").alias("jump"), F.lit(1).cast("long").alias("members"), F.col("total").alias("chars"), (F.col("total") - F.col("before")).alias("own"), F.col("leaf").alias("leaves"))
    while not state.where("jump is not null").isEmpty():
        before = state
        more = state.where("jump is not null").groupBy("jump").agg(*(F.sum(c).alias(f"{c}_more") for c in SUMS)).withColumnRenamed("jump", "conv_id")
        far = state.select(F.col("conv_id").alias("jump"), F.col("jump").alias("far"))
        # Chains without a pointer stay out of the join on it, where they would be one key.
        moved = state.where("jump is not null").join(far, "jump").select("conv_id", F.col("far").alias("jump"), *SUMS)
        both = moved.union(state.where("jump is null"))
        state = cut(both.join(more, "conv_id", "left").select("conv_id", "jump", *((F.col(c) + F.coalesce(f"{c}_more", F.lit(0))).alias(c) for c in SUMS)))
        forget(before)
    return base.join(state.drop("jump"), "conv_id")


ENDS = "conv_id long, depth long, ends_sha256 string"


def ends(found: DataFrame) -> DataFrame:
    """For each node that conversations end at: SHA-256 of their decimal ids, ascending, comma-joined.

    The ids of a node stream through one task in order; memory does not grow with them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        out, now, digest = [], None, None
        for key, new, part in runs(batches):
            at = part.column(1).to_pylist()
            if new:
                if digest is not None:
                    out.append((*now, digest.hexdigest()))
                digest = None
            for depth, ids in by_depth(at, part.column(2).to_pylist()):
                if digest is None or now != (key, depth):
                    if digest is not None:
                        out.append((*now, digest.hexdigest()))
                    now, digest = (key, depth), hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(",".join(map(str, ids)).encode())
            if len(out) >= BATCH_ROWS:
                yield pack(out, ENDS)
                out = []
        if digest is not None:
            out.append((*now, digest.hexdigest()))
        if out:
            yield pack(out, ENDS)

    owned = F.col("n") >= F.col("first")
    rows = found.select(F.when(owned, F.col("conv_id")).otherwise(F.col("parent")).alias("owner"), F.when(owned, F.col("n")).otherwise(F.col("attach")).alias("depth"), "conv_id")
    spark = found.sparkSession
    ship(spark)
    return rows.repartition(n_partitions(spark), "owner", "depth").sortWithinPartitions("owner", "depth", "conv_id").mapInArrow(run, ENDS)


def by_depth(depths: list[int], ids: list[int]) -> Iterator[tuple[int, list[int]]]:
    first = 0
    for i in range(1, len(depths) + 1):
        if i == len(depths) or depths[i] != depths[first]:
            yield depths[first], ids[first:i]
            first = i


EMPTY = hashlib.sha256(b"").hexdigest()


def tree(parts: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of conversations given as ``paths`` parts.

    ``conv_id`` (smallest member) and ``depth`` name a node; ``parent_conv_id`` (root: null), ``n_convs``
    members, ``n_children``, ``n_leaves`` childless nodes at or below it, ``saved_tokens``: over the nodes at
    or below it (n_convs - 1) times the code points of its last text, ``ends_sha256`` of those that end there.
    Repeated conversations are members of the same nodes.  A conversation without turns ends at the root.
    No conversation: empty result, without a root.
    """
    found = cut(paths(parts))
    each = cut(subtrees(chains(found)))
    off = each.where("parent is not null").groupBy("parent", "attach").agg(*(F.sum(c).alias(f"{c}_off") for c in SUMS), F.count_if(F.col("n") >= F.col("first")).alias("kids"))
    off = off.withColumnsRenamed({"parent": "conv_id", "attach": "depth"})
    nodes = found.select("conv_id", "depth", "chars", "upto").join(each.select("conv_id", "n", "total", "first", "parent", "leaf"), "conv_id").where("depth >= first")
    nodes = nodes.join(off, ["conv_id", "depth"], "left").join(ends(each), ["conv_id", "depth"], "left")
    below = W.partitionBy("conv_id").orderBy(F.desc("depth"))
    sums = {c: F.coalesce(F.sum(f"{c}_off").over(below), F.lit(0)) for c in SUMS}
    nodes = nodes.select("*", *(s.alias(f"{c}_below") for c, s in sums.items()))
    n_convs, ahead = F.col("members_below") + 1, F.col("upto") - F.col("chars")
    saved = (F.col("total") + F.col("chars_below") - n_convs * ahead) - (F.col("total") - ahead + F.col("own_below"))
    return nodes.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        n_convs.alias("n_convs"),
        (F.when(F.col("depth") < F.col("n"), 1).otherwise(0) + F.coalesce("kids", F.lit(0))).cast("long").alias("n_children"),
        (F.col("leaf") + F.col("leaves_below")).alias("n_leaves"),
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"),
    )


def prefix_tree(turns: DataFrame) -> DataFrame:
    """``tree`` of a table of turns (``conv_id, turn, role, text``) as they are.

    Turns stand by turn (nulls first), ties by their digest.  Null role or text: empty.  Rows without a
    conv_id are in no conversation.  Repeated rows are turns of their own.  Further columns are dropped.
    """
    return tree(own_turns(turn_digests(turns)))


def run(spark, sf_dir: str) -> DataFrame:
    return tree(rebuilt(turn_digests(table(spark, sf_dir, "conversations"))))


#: The same in DuckDB, where a prefix is the digests of its turns in one string and a node meets each of those above it.
TREE_SQL = f"""
WITH t AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos FROM (
    SELECT conv_id, turn, sha256(length(role) || ':' || role || text) AS digest, length(text) AS chars
    FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))
), c AS (SELECT conv_id, {crc32_sql("conv_id::VARCHAR")} % 6 AS h, conv_id - conv_id % 100 AS base FROM (SELECT DISTINCT conv_id FROM t)
), parts AS (
  SELECT c.conv_id, 0 AS side, pos, digest, chars FROM c JOIN t ON t.conv_id = base AND pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, digest, chars FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h
), prefixes AS (
  SELECT conv_id, row_number() OVER w AS depth, string_agg(digest, '') OVER w AS path, chars FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY side, pos)
  UNION ALL SELECT conv_id, 0, '', 0 FROM c
), ended AS (SELECT *, depth = max(depth) OVER (PARTITION BY conv_id) AS last FROM prefixes
), nodes AS (
  SELECT path, min(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256 FROM ended GROUP BY path
), kids AS (SELECT path[:-65] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), whole AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (path)
), below AS (
  SELECT p.path, count(*) FILTER (w.n_children = 0) AS n_leaves, sum((w.n_convs - 1) * w.chars) AS saved
  FROM whole AS w JOIN prefixes AS p ON p.conv_id = w.conv_id AND p.depth <= w.depth GROUP BY p.path
)
SELECT w.conv_id, w.depth::BIGINT AS depth, CASE WHEN w.depth > 0 THEN up.conv_id END AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, w.ends_sha256
FROM whole AS w JOIN below USING (path) LEFT JOIN nodes AS up ON w.depth > 0 AND up.path = w.path[:-65]
"""
