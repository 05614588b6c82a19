"""Repair of conversation structure at least cost, by dynamic programming over a trie of signatures.

A conversation's rows become a signature of one byte each: the role's initial, whether the row must
go and whether its text is truncated.  Signatures are sorted and stream through a task, which keeps the
one open path of their prefix trie: the layers of the prefix that a signature shares with the one
before it are there already, only the rest is computed, and the answer is given where it ends.

A layer holds for each state of the grammar ``(s?(ua)+)?`` the least cost of reaching it and, for
ties, the place of its edit string among those of the other states.  Strings of one layer end with
a row's edit and so none begins with another, so their order decides that of all that follows; the
strings themselves are read off once, at the end of a signature.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanweave.shipping import ship

from .common import BATCH_ROWS, crc32_sql, cut, n_partitions, release, runs, table

SPACE = " \t\n\x0b\x0c\r"
#: States: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after one more empty row of the role that fits.
NEXT = (USER, USER, ASSISTANT, USER)
#: Edits' costs; an undeleted truncated row costs one more.
REROLE, DELETE, INSERT = 2, 3, 2
MUST_GO = ord("x")


def damage(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` of each row with one of five faults, or none, by its crc32.

    crc32 of ``conv_id:turn`` mod 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it,
    3 repeats it, 4 makes it the user's.  Null role or text: one space, as a null id or turn is in the
    hashed string; the columns keep it null.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def prepared(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, h``: nulls of role and text as one space, h the text's digest for ties."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), blank("role").alias("role"), blank("text").alias("text"))
    return rows.withColumn("h", F.sha2("text", 256))


def faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, h, initial, fault, symbol`` of ``prepared`` rows; texts stay behind.

    fault: 1 blank, 2 duplicate (role and text met earlier in the conversation), 3 truncated (its last
    character but white space is none of ``.!?``), 0 none; the first that fits.  symbol: the signature's byte.
    """
    # Rows of one conversation are dealt by their text, so a long one is not one task.
    nth = F.row_number().over(W.partitionBy("conv_id", "role", "h").orderBy("turn"))
    end = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select("conv_id", "turn", "role", "h", (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("open"))
    fault = F.when(F.col("blank"), 1).when(nth > 1, 2).when(F.col("open"), 3).otherwise(0)
    first = F.substring("role", 1, 1)
    initial = F.when(first.isin("s", "u", "a"), F.ascii(first)).otherwise(ord("o"))
    found = narrow.select("conv_id", "turn", "role", "h", initial.cast("int").alias("initial"), fault.cast("int").alias("fault"))
    # Truncated rows have the initial's capital.
    symbol = F.when(F.col("fault").isin(1, 2), MUST_GO).when(F.col("fault") == 3, F.col("initial") - 32).otherwise(F.col("initial"))
    return found.withColumn("symbol", symbol.cast("int"))


SIGNATURE = "conv_id long, signature binary, gaps long, blank long, duplicate long, truncated long, illegal long"
LEGAL = np.array([ord(a) << 8 | ord(b) for a, b in ("su", "ua", "au")])


def signatures(found: DataFrame) -> DataFrame:
    """One row for each conversation of ``faults``: its signature and counts.

    Rows stand by turn (nulls first), ties by role and the text's digest, copies last.  gaps: turn numbers missing
    between the least and the greatest.  illegal: neighbours whose initials are not su, ua or au.  A
    conversation streams through one task, which holds one byte of each of its rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        out, now, state = [], None, None

        def row():
            sig, seen, low, high, counts, illegal, _, _ = state
            return (now, b"".join(sig), (high - low + 1 - seen) if seen else 0, counts[1], counts[2], counts[3], illegal)

        for key, new, part in runs(batches):
            if new:
                if state is not None:
                    out.append(row())
                    if len(out) >= BATCH_ROWS:
                        yield pack(out, SIGNATURE)
                        out = []
                now, state = key, [[], 0, None, None, np.zeros(4, np.int64).tolist(), 0, None, None]
            symbols, initial = part.column(4).to_numpy().astype(np.uint8), part.column(2).to_numpy()
            turns = part.column(1).drop_null().to_numpy()
            state[0].append(symbols.tobytes())
            if len(turns):
                state[1] += int((turns[1:] != turns[:-1]).sum()) + (turns[0] != state[7])
                state[2], state[3], state[7] = int(turns[0]) if state[2] is None else state[2], int(turns[-1]), turns[-1]
            state[4] = [a + b for a, b in zip(state[4], np.bincount(part.column(3).to_numpy(), minlength=4).tolist(), strict=True)]
            pairs = initial[:-1] << 8 | initial[1:]
            state[5] += int((~np.isin(pairs, LEGAL)).sum())
            if state[6] is not None:
                state[5] += int((state[6] << 8 | int(initial[0])) not in LEGAL)
            state[6] = int(initial[-1])
        if state is not None:
            out.append(row())
        if out:
            yield pack(out, SIGNATURE)

    spark = found.sparkSession
    ship(spark)
    ordered = found.repartition(n_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "h", F.col("fault") == 2)
    return ordered.select("conv_id", "turn", "initial", "fault", "symbol").mapInArrow(run, SIGNATURE)


def pack(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "int": pa.int32()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names))


class Layers:
    """Layers of the dynamic program, kept by their content: of costs only the differences count.

    There are few different ones, so a step is looked up where it was taken before, in any signature.
    """

    def __init__(self):
        first = ((0, 0), None, None, None)
        self.ids, self.all, self.steps = {first: 0}, [first], {}

    def step(self, layer: int, symbol: int) -> tuple[int, int, tuple]:
        """The next layer, what its least cost adds, and for each state (state before, edits)."""
        if (got := self.steps.get((layer, symbol))) is None:
            got = self.steps[layer, symbol] = self._step(self.all[layer], symbol)
        return got

    def _step(self, layer: tuple, symbol: int) -> tuple[int, int, tuple]:
        role, open_ = chr(symbol).lower(), chr(symbol).isupper()
        best: list[tuple | None] = [None] * 4
        for before, held in enumerate(layer):
            if held is None:
                continue
            cost, place = held
            at = before
            for inserts in range(3):  # a third would lead to a state that one alone reaches
                edits = [("D", at, DELETE)]
                if symbol != MUST_GO:
                    kept = SYSTEM if role == "s" and at == START else NEXT[at] if role == "ua"[NEXT[at] - USER] else None
                    if kept is not None:
                        edits.append(("K", kept, open_))
                    edits.append(("R", NEXT[at], REROLE + open_))
                for letter, to, price in edits:
                    option = (cost + INSERT * inserts + price, place, "I" * inserts + letter, before)
                    if best[to] is None or option < best[to]:
                        best[to] = option
                at = NEXT[at]
        least = min(o[0] for o in best if o)
        order = sorted(o[1:3] for o in best if o)
        new = tuple(o and (o[0] - least, order.index(o[1:3])) for o in best)
        if new not in self.ids:
            self.ids[new] = len(self.all)
            self.all.append(new)
        return self.ids[new], least, tuple(o and (o[3], o[2]) for o in best)

    def end(self, layer: int) -> tuple[int, int, str]:
        """What ending here adds, the state it ends from, and the last insertions."""
        options = []
        for state, held in enumerate(self.all[layer]):
            if held:
                inserts = (0, 2, 1, 0)[state]
                options.append((held[0] + INSERT * inserts, held[1], "I" * inserts, state))
        cost, _, edits, state = min(options)
        return cost, state, edits


def shared(a: bytes, b: bytes) -> int:
    """Length of the prefix that both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class Path:
    """The open path of the trie: the layers of the signature last met."""

    def __init__(self):
        self.layers, self.signature = Layers(), b""
        self.ids, self.costs, self.backs = [0], [0], []
        self.computed = 0

    def answer(self, signature: bytes) -> tuple[int, str]:
        """Least cost and least string of edits of a signature."""
        keep = shared(self.signature, signature)
        del self.ids[keep + 1 :], self.costs[keep + 1 :], self.backs[keep:]
        for symbol in signature[keep:]:
            to, more, back = self.layers.step(self.ids[-1], symbol)
            self.ids.append(to)
            self.costs.append(self.costs[-1] + more)
            self.backs.append(back)
        self.computed += len(signature) - keep
        self.signature = signature
        cost, state, edits = self.layers.end(self.ids[-1])
        said = [edits]
        for back in reversed(self.backs):
            state, edits = back[state]
            said.append(edits)
        return self.costs[-1] + cost, "".join(reversed(said))


AUDIT = SIGNATURE + ", cost long, audit string"


def audits(found: DataFrame) -> DataFrame:
    """``signatures`` rows with ``cost`` and ``audit``: the cheapest edits' initials, of equal ones the ASCII-least.

    Signatures are dealt by ranges of their order, so that those with a long prefix in common meet; one
    that very many conversations have is split by id.  A task holds the layers of one signature.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        path, last, answer = Path(), None, None
        for batch in batches:
            costs, edits = [], []
            for signature in batch.column(1).to_pylist():
                if signature != last:
                    last, answer = signature, path.answer(signature)
                costs.append(answer[0])
                edits.append(answer[1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.int64()), pa.array(edits, pa.string())], [*batch.schema.names, "cost", "audit"])

    spark = found.sparkSession
    ship(spark)
    return found.repartitionByRange(n_partitions(spark), "signature", "conv_id").sortWithinPartitions("signature", "conv_id").mapInArrow(run, AUDIT)


REPAIRED = "conv_id long, position long, role string, text string"


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, position, role, text``: the rows of each conversation after its edits, in order.

    ``rows`` are ``prepared``, ``found`` has their ``conv_id, audit``.  A conversation's rows are in
    one partition and follow one another there.  They stream; a task holds one audit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        out, now, audit, at, place, role = [], None, "", 0, 0, ""

        def insert() -> None:
            nonlocal at, place, role
            while at < len(audit) and audit[at] == "I":
                role = "assistant" if role[:1] == "u" else "user"
                out.append((now, place, role, ""))
                at, place = at + 1, place + 1

        for key, new, part in runs(batches):
            texts = zip(*(part.column(i).to_pylist() for i in (1, 2, 3)), strict=True)
            if new:
                insert()
                now, at, place, role = key, 0, 0, ""
                audit, _, _ = next(texts)
            for _, own, text in texts:
                insert()
                edit, at = audit[at], at + 1
                if edit != "D":
                    role = own if edit == "K" else "assistant" if role[:1] == "u" else "user"
                    out.append((now, place, role, text))
                    place += 1
                if len(out) >= BATCH_ROWS:
                    yield pack(out, REPAIRED)
                    out = []
        insert()
        if out:
            yield pack(out, REPAIRED)

    spark = rows.sparkSession
    ship(spark)
    first = found.select("conv_id", F.lit(0).alias("__side"), "audit", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("h"), F.lit("").alias("text"))
    rest = rows.select("conv_id", F.lit(1).alias("__side"), F.lit(None).cast("string").alias("audit"), "turn", "role", "h", "text")
    both = first.union(rest).repartition(n_partitions(spark), "conv_id").sortWithinPartitions("conv_id", "__side", "turn", "role", "h")
    return both.select("conv_id", "audit", "role", "text").mapInArrow(run, REPAIRED)


DIGEST = "conv_id long, repaired_sha256 string"


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` rows, newline-joined; for rows as ``repaired`` gives them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, now, digest = [], None, None
        for key, new, part in runs(batches):
            if new:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            said = pc.binary_join_element_wise(part.column(1), part.column(2), ":").to_pylist()
            digest.update("\n".join(said).encode("utf-8", "surrogatepass"))
            if len(out) >= BATCH_ROWS:
                yield pack(out, DIGEST)
                out = []
        if digest is not None:
            out.append((now, digest.hexdigest()))
        if out:
            yield pack(out, DIGEST)

    return turns.select("conv_id", "role", "text").mapInArrow(run, DIGEST)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The conversations' ``audits`` and their ``repaired`` rows.

    Edits: keep costs 0, rerole to user or assistant 2, delete 3 (blank and duplicate rows must go), insert
    an empty user or assistant row 2; a truncated row that stays 1 more.  Afterwards the roles' initials are
    ``(s?(ua)+)?``.  Null conv_id: one conversation of its own.  Null role or text: one space; a
    role of another initial, or none, fits nowhere and must change or go.  Null turns come first; rows of
    one turn by role and the text's digest, so copies of a row stand side by side.  Conversations
    whose rows all go have an audit and no repaired row.  Empty table: two empty results.  Further
    columns are dropped.  Texts are shuffled once; a conversation streams through one task.
    """
    rows = prepared(turns)
    found = cut(audits(cut(signatures(faults(rows)))))
    return found, repaired(rows, found)


EMPTY = hashlib.sha256(b"").hexdigest()
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def run(spark, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    found, rows = repair(damage(turns))
    every = turns.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    both = every.join(found, every["conv_id"].eqNullSafe(found["conv_id"]), "left").drop(found["conv_id"])
    said = digests(rows)
    both = both.join(said, both["conv_id"].eqNullSafe(said["conv_id"]), "left").drop(said["conv_id"])
    return both.select(
        "conv_id", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY)).alias("repaired_sha256")
    )


#: The same in DuckDB, where a conversation's states are rows and each round of the recursion takes one of
#: its rows; a state's cost and edits are one string that orders as they do.
REPAIR_SQL = f"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
), kinds AS (SELECT *, {crc32_sql("k")} % 20 AS kind FROM keyed
), ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)
), damaged AS (
  SELECT c, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM kinds JOIN ids ON ids.conv_id IS NOT DISTINCT FROM kinds.conv_id, (VALUES (0), (1)) AS copies(copy)
  WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE 'o' END AS i FROM damaged
), met AS (SELECT *, row_number() OVER (PARTITION BY c, role, text ORDER BY pos) AS nth FROM numbered
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 1 WHEN nth > 1 THEN 2 WHEN body[-1] NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
    lag(i) OVER (PARTITION BY c ORDER BY pos) || i AS pair FROM met
), counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank,
    count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM faulty GROUP BY c
), inserts(state, k, mid) AS (
  VALUES (0, 0, 0), (0, 1, 2), (0, 2, 3), (1, 0, 1), (1, 1, 2), (1, 2, 3), (2, 0, 2), (2, 1, 3), (2, 2, 2), (3, 0, 3), (3, 1, 2), (3, 2, 3)
), options AS (
  SELECT c, pos, state, repeat('I', k::INT) || e AS edits, k * 2 + price AS price, dest FROM (
    SELECT c, pos, state, k, 'D' AS e, 3 AS price, mid AS dest FROM faulty, inserts
    UNION ALL SELECT c, pos, state, k, 'R', 2 + (fault = 3)::INT, CASE mid WHEN 2 THEN 3 ELSE 2 END FROM faulty, inserts WHERE fault IN (0, 3)
    UNION ALL SELECT c, pos, state, k, 'K', (fault = 3)::INT, CASE i WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END FROM faulty, inserts
      WHERE fault IN (0, 3) AND ((i = 's' AND mid = 0) OR (i = 'u' AND mid <> 2) OR (i = 'a' AND mid = 2)))
), states AS (
  SELECT c, 0::BIGINT AS pos, 0 AS state, '000000000' AS best FROM counts
  UNION ALL
  SELECT s.c, o.pos, o.dest, min(lpad((substr(s.best, 1, 9)::INT + o.price)::VARCHAR, 9, '0') || substr(s.best, 10) || o.edits)
  FROM states AS s JOIN options AS o ON o.c = s.c AND o.pos = s.pos + 1 AND o.state = s.state GROUP BY s.c, o.pos, o.dest
), answers AS (
  SELECT c, min(lpad((substr(best, 1, 9)::INT + more)::VARCHAR, 9, '0') || substr(best, 10) || tail) AS best
  FROM states JOIN counts USING (c) JOIN (VALUES (0, 0, ''), (1, 4, 'II'), (2, 2, 'I'), (3, 0, '')) AS finish(state, more, tail) USING (state)
  WHERE pos = n GROUP BY c
), letters AS (
  SELECT c, unnest(range(1, length(best) - 8)) AS mid, unnest(string_split(substr(best, 10), '')) AS e FROM answers WHERE length(best) > 9
), placed AS (
  SELECT *, count(*) FILTER (e <> 'I') OVER w AS pos, count(*) FILTER (e <> 'D') OVER w AS o FROM letters WINDOW w AS (PARTITION BY c ORDER BY mid)
), shown AS (
  SELECT p.*, f.role, f.i, CASE e WHEN 'I' THEN '' ELSE f.text END AS text,
    max((o = 1 AND e = 'K' AND i = 's')::INT) OVER (PARTITION BY p.c) AS led FROM placed AS p LEFT JOIN faulty AS f ON f.c = p.c AND f.pos = p.pos
), said AS (
  SELECT c, sha256(string_agg(CASE e WHEN 'K' THEN role ELSE CASE WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END END || ':' || text, chr(10) ORDER BY mid)) AS hash
  FROM shown WHERE e <> 'D' GROUP BY c
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(substr(best, 1, 9)::BIGINT, 0) AS cost, coalesce(substr(best, 10), '') AS audit, coalesce(hash, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN counts USING (c) LEFT JOIN answers USING (c) LEFT JOIN said USING (c)
"""
