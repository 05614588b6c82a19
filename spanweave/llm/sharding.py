"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a prime-sized table.  Shards take
turns; each claims the first slot on its list that is still free, until none is.  Every shard gets
an equal share of slots but for one, a key's place is one lookup, and adding or removing a shard
moves few slots besides those it gains or loses.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SLOTS, SHARDS = 65_537, 64


def preferences(name: str, slots: int) -> tuple[int, int]:
    """First slot and stride of a shard's permutation; the size being prime, it meets every slot."""
    digest = hashlib.md5(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:], "big") % (slots - 1) + 1


def fill(names: list[str], slots: int = SLOTS) -> list[int]:
    """The shard's index for each slot."""
    if not names or slots < len(names) or slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table needs shards and a prime number of slots, not fewer than shards")
    places = [preferences(n, slots) for n in names]
    taken, turn = [-1] * slots, [0] * len(names)
    left = slots
    while left:
        for k, (first, stride) in enumerate(places):
            while taken[at := (first + turn[k] * stride) % slots] >= 0:
                turn[k] += 1
            taken[at] = k
            left -= 1
            if not left:
                break
    return taken


def place(df: DataFrame, key, names: list[str], slots: int = SLOTS) -> DataFrame:
    """``df`` with the ``slot`` and ``shard`` (name) of each row, by the digest of ``key``.

    The table has ``slots`` rows whatever the input and is broadcast; rows are not shuffled.
    Null keys: as the empty key.  Repeated keys: one place.  Empty table: empty result.  Columns
    of the input called slot or shard are replaced, the key's own among them.
    """
    spark = df.sparkSession
    lookup = spark.createDataFrame([(i, names[k]) for i, k in enumerate(fill(names, slots))], "__sw_slot long, __sw_shard string")
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    slot = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots
    # The key is read first: it may be a column of these names itself.
    out = df.withColumn("__sw_slot", slot).drop("slot", "shard").join(F.broadcast(lookup), "__sw_slot", "left")
    return out.withColumnsRenamed({"__sw_slot": "slot", "__sw_shard": "shard"})


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05d}" for i in range(n)]


def run(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return place(docs.select("doc_id"), F.col("doc_id"), shard_names()).select("doc_id", "slot", "shard")


def placement_sql() -> str:
    """The same places in SQL (DuckDB), the filled table given as a list."""
    filled = ",".join(map(str, fill(shard_names())))
    return f"""
WITH t AS (SELECT [{filled}] AS shards),
s AS (SELECT doc_id, ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {SLOTS} AS slot FROM documents)
SELECT doc_id, slot, printf('shard-%05d', shards[slot + 1]) AS shard FROM s, t
"""
