"""Conversation repair, the prefix trie and language profiles against plain versions."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from spanweave.llm import languages, prefixes, registry, repair
from spanweave.llm.common import table

TURNS = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
ROLES = ("user", "assistant", "system", "tool", "", None)
TEXTS = ("Yes.", "No!", "and so", "", " \t", None, "Yes. ")
#: Nulls in every column, copies, ties, a conversation of one row, gaps.
ODD = [
    (1, 0, "user", "Hello."), (1, 0, "user", "Hello."), (1, None, "assistant", "Before all."), (1, 7, None, None), (1, 7, "assistant", "x"),
    (None, 0, "user", "Whose?"), (None, None, None, None), (-100, 0, "system", "Be brief."), (-100, 1, "system", "Be brief."), (-7, 3, "assistant", "word. " * 5000),
    (200, 0, "user", "a"), (250, 0, "user", "a"), (201, 0, "user", "a"), (201, 1, "assistant", "é"), (299, -5, "", "\x00"),
]
CLASHING = ("h", "symbol", "fault", "audit", "__side", "depth", "digest", "owner", "jump", "n", "side", "gram", "held_out", "score")


def turns(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if clashing else df


# --- 11


def key(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest())


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = name(role), name(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def fault_of(i, rows):
    _, _, role, text = rows[i]
    body = text.rstrip(" \t\n\v\f\r")
    if not body:
        return "blank"
    if (role, text) in [r[2:] for r in rows[:i]]:
        return "duplicate"
    return "truncated" if body[-1] not in ".!?" else None


def every_edit(rows, at, most):
    """All strings of edits up to a cost, with the rows they give."""
    if at == len(rows):
        yield 0, "", []
        if most >= 2:
            for name in ("user", "assistant"):
                for cost, edits, out in every_edit(rows, at, most - 2):
                    yield cost + 2, "I" + edits, [(name, ""), *out]
        return
    _, _, role, text = rows[at]
    fault = fault_of(at, rows)
    more = fault == "truncated"
    options = [(3, "D", [])]
    if fault not in ("blank", "duplicate"):
        options += [(more, "K", [(role, text)]), (2 + more, "R", [("user", text)]), (2 + more, "R", [("assistant", text)])]
    for cost, letter, own in options:
        if cost <= most:
            for rest, edits, out in every_edit(rows, at + 1, most - cost):
                yield cost + rest, letter + edits, own + out
    if most >= 2:
        for name in ("user", "assistant"):
            for cost, edits, out in every_edit(rows, at, most - 2):
                yield cost + 2, "I" + edits, [(name, ""), *out]


def plain_repair(rows):
    """Cost, edits and rows of a conversation in order, by trying all that is no dearer than deleting all."""
    fits = lambda out: all(r[0] for r in out) and GRAMMAR.match("".join(r[0][0] for r in out))
    for most in range(3 * len(rows) + 1):
        if found := [(c, e, o) for c, e, o in every_edit(rows, 0, most) if fits(o)]:
            return min(found, key=lambda f: f[:2])
    raise AssertionError


def plain_row(conv, rows):
    rows = sorted(rows, key=key)
    if not rows:
        return conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    said = [fault_of(i, rows) for i in range(len(rows))]
    numbers = {r[1] for r in rows} - {None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, edits, out = plain_repair(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return conv, gaps, *(said.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, digest


def write(spark, folder, rows):
    turns(spark, rows).write.parquet(str(folder / "conversations.parquet"))
    return str(folder)


def some_turns(seed, conversations, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(ROLES) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn + rng.choice((0, 0, 0, 2)), role, rng.choice(TEXTS) if rng.random() < 0.5 else f"turn {turn}."))
    return rows


@pytest.mark.parametrize("rows", [some_turns(1, 60, 5), ODD, []])
def test_repair_equals_every_edit_tried(spark, tmp_path, rows):
    by = collections.defaultdict(list)
    for r in plain_damage(rows):
        by[r[0]].append(r)
    expected = {plain_row(c, by[c]) for c in {r[0] for r in rows}}
    found = [tuple(r) for r in repair.run(spark, write(spark, tmp_path, rows)).collect()]
    assert len(found) == len(expected) and set(found) == expected


def test_repaired_rows_fit_the_grammar(spark, sf):
    rows = repair.damage(table(spark, sf, "conversations"))
    found, fixed = repair.repair(rows)
    by = collections.defaultdict(list)
    for r in fixed.collect():
        by[r.conv_id].append((r.position, r.role, r.text))
    for said in by.values():
        assert [p for p, *_ in sorted(said)] == list(range(len(said)))
        assert GRAMMAR.match("".join(r[0] for _, r, _ in sorted(said)))
    assert {r.conv_id: r.audit.count("K") + r.audit.count("I") + r.audit.count("R") for r in found.collect() if set(r.audit) - {"D"}} == {c: len(v) for c, v in by.items()}


def test_prefixes_are_computed_once():
    rng = random.Random(3)
    signatures = sorted("".join(rng.choice("uaxUA") for _ in range(rng.randint(0, 8))).encode() for _ in range(400))
    path = repair.Path()
    found = [path.answer(s) for s in signatures]
    prefixes_met = {s[:i] for s in signatures for i in range(1, len(s) + 1)}
    assert path.computed == len(prefixes_met) < sum(map(len, signatures))
    assert found == [repair.Path().answer(s) for s in signatures]
    assert len(path.layers.all) < 200  # few, however many signatures


def test_a_long_conversation_is_repaired(spark):
    rows = [(5, i, "user", f"said {i}.") for i in range(30_000)]
    found, fixed = repair.repair(spark.createDataFrame(rows, TURNS))
    row = found.first()
    # A second user in a row is answered by an inserted assistant or made one, at the same cost: ASCII-least is the insertion.
    assert row.cost == 30_000 and row.illegal == 29_999 and fixed.count() == 30_000 and set(row.audit) <= set("IKR")


# --- 12


def plain_tree(rows, share=True):
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    order = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest())
    own = {c: [r[2:] for r in sorted((r for r in rows if r[0] == c), key=order)] for c in {r[0] for r in rows}}
    built = dict(own)
    if share:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 6
            base = c - int(abs(c) % 100) * (1 if c >= 0 else -1)
            built[c] = own.get(base, [])[:h] + own[c][h:]
    members = collections.defaultdict(list)
    for c, said in built.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    out = set()
    for node, inside in members.items():
        below = [n for n in members if n[: len(node)] == node]
        leaf = lambda n: not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in members)
        ends = ",".join(str(c) for c in sorted(inside) if len(built[c]) == len(node))
        out.add((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), sum(len(m) == len(node) + 1 for m in below), sum(map(leaf, below)),
            sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def nested(n):
    """Each conversation goes on from where the one before it ends, so chains are nested n deep."""
    return [(c, t, "user", f"turn {t}") for c in range(n) for t in range(c + 1)]


@pytest.mark.parametrize("rows", [some_turns(2, 40, 4), ODD, [], nested(12), [(c, 0, "user", "all alike") for c in range(50)], [(7, None, "user", None)]])
def test_tree_equals_brute_force(spark, tmp_path, rows):
    found = [tuple(r) for r in prefixes.run(spark, write(spark, tmp_path, rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_tree(rows)
    found = [tuple(r) for r in prefixes.prefix_tree(turns(spark, rows)).collect()]
    assert len(found) == len(set(found)) and set(found) == plain_tree(rows, share=False)


def test_search_goes_far_down(spark):
    """Conversations of different lengths that share up to hundreds of turns."""
    rng = random.Random(4)
    rows = []
    for c in range(12):
        cut = rng.randint(0, 150)
        rows += [(c, t, "user", "so" if t < cut else f"{c} alone") for t in range(rng.randint(cut, 170))]
    found = {tuple(r) for r in prefixes.prefix_tree(turns(spark, rows)).collect()}
    by = collections.defaultdict(set)
    said = {c: tuple(x for k, _, _, x in rows if k == c) for c in {r[0] for r in rows}}
    for c, s in said.items():
        for d in range(len(s) + 1):
            by[s[:d]].add(c)
    assert {(r[0], r[1], r[3]) for r in found} == {(min(m), len(n), len(m)) for n, m in by.items()}
    assert {(r[0], r[1], r[2]) for r in found} == {(min(m), len(n), min(by[n[:-1]]) if n else None) for n, m in by.items()}


@pytest.mark.parametrize("name", ["op11_repair", "op12_prefixes"])
def test_sql_gives_the_same(spark, tmp_path, name):
    folder = write(spark, tmp_path, ODD + some_turns(5, 40, 6))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    cursor = db.execute(registry.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    found = registry.QUERIES[name](spark, folder)
    assert collections.Counter(map(tuple, found.select(*columns).collect())) == collections.Counter(cursor.fetchall())


# --- 13


def plain_grams(text):
    words = re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in text))
    met = collections.Counter()
    for word in words:
        word = f" {''.join(c.lower() if len(c.lower()) == 1 else c for c in word)} "
        for n in (1, 2, 3):
            met.update(word[i : i + n] for i in range(len(word) - n + 1))
    return collections.Counter({g: n for g, n in met.items() if g != " "})


def plain_profile(met, most):
    order = lambda g: [0] * (3 - len(g)) + [ord(c) for c in g]
    return [g for g, _ in sorted(met.items(), key=lambda m: (-m[1], order(m[0])))[:most]]


def plain_languages(rows, most):
    met = collections.defaultdict(collections.Counter)
    for i, text, lang in rows:
        if None not in (i, text, lang) and zlib.crc32(str(i).encode()) % 5:
            met[lang] += plain_grams(text)
    profiles = {lang: {g: n for n, g in enumerate(plain_profile(m, most))} for lang, m in sorted(met.items())}
    for i, text, _ in rows:
        own = plain_profile(plain_grams(text or ""), most)
        held = i is not None and zlib.crc32(str(i).encode()) % 5 == 0
        if not own or not profiles:
            yield i, held, "und", 0.0
            continue
        far = {lang: sum(abs(p[g] - n) if g in p else most for n, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(far, key=far.get)
        yield i, held, best, round(1 - far[best] / (most * len(own)), 9)


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_grams_equal_plain_ones(monkeypatch, block):
    monkeypatch.setattr(languages, "BLOCK", block)
    for text in ("", "a", "  ", "Ab cd", "İstanbul ǅ 12 straße", "é\x00x", "one two  three\nfour" * 5, "x" * 50, "漢字 かな", "3 + 4"):
        found = {"".join(chr(int(g) >> s & 0x1FFFFF) for s in (42, 21, 0) if int(g) >> s): int(n) for g, n in zip(*languages.grams(text), strict=True)}
        assert found == plain_grams(text)


def test_languages_equal_plain_ones(spark, sf):
    rows = [tuple(r) for r in table(spark, sf, "documents").select("doc_id", "text", "lang").collect()]
    odd = [(None, "the end", "en"), (10**6, None, "en"), (10**6 + 1, "", None), (10**6 + 2, "12 %", "fr"), (10**6 + 3, "the " * 30_000, None), *rows[:3]]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumns({c: F.lit(c) for c in CLASHING})
    found = [(r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in languages.predict(df, languages.train(df, 200), 200).collect()]
    assert collections.Counter(found) == collections.Counter(plain_languages(rows + odd, 200))


def test_held_out_languages(spark, sf):
    said = {r.doc_id: r for r in registry.op13_languages(spark, sf).collect()}
    held = [(r.lang, said[r.doc_id].lang_pred) for r in table(spark, sf, "documents").collect() if said[r.doc_id].held_out]
    assert len(held) > 20 and sum(a == b for a, b in held) >= 0.98 * len(held)


def test_no_documents_no_languages(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert languages.train(df) == {} and languages.predict(df, {}).count() == 0
    one = spark.createDataFrame([(1, "word", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in languages.predict(one, languages.train(one)).collect()] == [(1, False, "und", 0.0)]
