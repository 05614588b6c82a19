"""Training-data operators on documents, against brute force."""

import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from spanweave.llm import bpe, decontaminate, quality, repeats, sharding, simhash, spotsigs
from spanweave.llm.common import table
from spanweave.llm.components import components
from spanweave.llm.registry import TOKENIZER
from spanweave.llm.suffixes import suffix_array

EDGE = [
    (1, None),
    (2, ""),
    (3, "the cat and the dog ran to the old red house by the sea on a long day"),
    (3, "the cat and the dog ran to the old red house by the sea on a long day"),
    (4, "the cat and the dog ran to the old red house by the sea on a long day"),
    (None, "of the \x00 é <|endoftext|> one"),
    (6, " \n\t "),
    (7, "word " * 4000),
    (8, "UPPER!! CASE!! 123 %%% $$$"),
    (9, "x"),
    (10, "é"),
]
#: Columns whose names operators might use themselves.
CLASHING = ("score", "fp", "component_id", "key", "anchor", "k1", "slot", "h", "d", "n", "text_hash", "range", "item_id", "part")


def documents(spark, rows, clashing=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.withColumns({c: F.lit(c) for c in CLASHING}) if clashing else df


@pytest.fixture(scope="module")
def edge(spark):
    return documents(spark, EDGE).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def texts(spark, sf):
    return {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}


# --- 10


def test_bpe_equals_the_tokenizers_library():
    from tokenizers import Tokenizer

    reference = Tokenizer.from_file(TOKENIZER)
    ours = bpe.TrieBpe(open(TOKENIZER, encoding="utf-8").read())
    rng = random.Random(1)
    letters = "aaab  '\n\t\r\x1c\x85<|endoftext|>éüñ0123 stheTHE.,!!$$$ 　"
    cases = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    cases += ["", "a" * 700, "<|endoftext|>", "x<|endoftext|>  <|endoftext|>y", *(f"{chr(c)}a {chr(c)} 1{chr(c)}" for c in range(0, 0x3100))]
    for text, expected in zip(cases, reference.encode_batch(cases, add_special_tokens=False), strict=True):
        ids = b"".join(ours.encode(text))
        assert list(memoryview(ids).cast("I")) == expected.ids, text
        assert ours.decode(ids).decode() == text


def test_bpe_of_a_very_long_text(monkeypatch):
    ours = bpe.TrieBpe(open(TOKENIZER, encoding="utf-8").read())
    text = "some words, é and numbers 123  " * 300
    whole = b"".join(ours.encode(text))
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    monkeypatch.setattr(bpe, "WORDS_AT_A_TIME", 7)
    assert b"".join(ours.encode(text)) == whole


def test_bpe_query_equals_the_library(spark, sf, texts):
    from tokenizers import Tokenizer

    from spanweave.llm import registry

    reference = Tokenizer.from_file(TOKENIZER)
    reference.no_truncation()
    reference.no_padding()
    rows = registry.op10_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = reference.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(reference.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edges(edge, none):
    rows = bpe.encode_documents(edge, TOKENIZER).collect()
    assert len(rows) == len(EDGE) and bpe.encode_documents(none, TOKENIZER).count() == 0
    digests = collections.Counter((r.doc_id, r.decoded_sha256) for r in rows)
    assert digests == collections.Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in EDGE)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2)} == {0}


# --- 1


def test_quality_separates_held_out_rows(spark, sf):
    docs, labels = table(spark, sf.replace("0.001", "0.01"), "documents"), table(spark, sf.replace("0.001", "0.01"), "labels")
    rows = quality.score_documents(docs, quality.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_quality_edges(spark, edge, none):
    labels = spark.createDataFrame([(3, 1, 0), (8, 0, 0), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(edge, quality.train(edge, labels)).collect()
    assert len(rows) == len(EDGE) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    constant = quality.train(edge, labels.limit(0))
    assert {r.score for r in quality.score_documents(edge, constant).collect()} == {0.5}
    assert quality.score_documents(none, constant).count() == 0
    assert quality.keep_good(edge, constant).count() == len(EDGE) and quality.keep_good(edge, constant).columns == edge.columns


def test_quality_cuts_change_no_indicator(monkeypatch):
    rng = random.Random(8)
    texts = ["The Quick brown fox!! jumps jumps 12 over *** it.\n" * 30, "x" * 500, " " * 300, "a " * 200, "ΑΣ ΑΣ, " * 60]
    texts += ["".join(rng.choice(["a", "B", "é", " ", "  ", "\u2003", "\n", "!", "same "]) for _ in range(rng.randint(0, 900))) for _ in range(60)]
    whole = [sorted(quality.Extractor()(t).tolist()) for t in texts]
    for size in (1, 7, 64):
        monkeypatch.setattr(quality, "BLOCK", size)
        assert [sorted(quality.Extractor()(t).tolist()) for t in texts] == whole


def plain_slots(text):
    """Indicators of a text, one n-gram after the other."""
    found, full = set(), 1 << 32

    def add(values, n, base, bits, first):
        for i in range(len(values) - n + 1):
            h = values[i] + (n << 24)
            for v in values[i + 1 : i + n]:
                h = (h * base + v) % full
            found.add(first + (((h ^ h >> 15) * int(quality.MIX) % full) >> 32 - bits))

    shapes = []
    words = text.split()
    for i, word in enumerate(words):
        bare = word.strip(quality.MARKS)
        case = 0 if word.islower() else 1 if word.isupper() else 2 if bare.istitle() else 3
        tail = 0 if word[-1] not in quality.MARKS else 1 if word[-1] in quality.STOPS else 2
        shapes.append(1 + case + 4 * tail + 16 * (i > 0 and words[i - 1] == word) + 32 * (not bare) + 64 * min(3, len(word) - len(bare)))
    add(list(text.lower().encode()), 3, 257, quality.CHAR_BITS, 0)
    for n in (1, 2, 3):
        add(shapes, n, 1021, quality.SHAPE_BITS, 1 << quality.CHAR_BITS)
    return found


def plain_svm(sets, y, rng):
    """NB-SVM by plain loops: (weight of each indicator, bias)."""
    count = {1: collections.Counter(), -1: collections.Counter()}
    for x, s in zip(sets, y, strict=True):
        count[s].update(x)
    total = {s: quality.SLOTS + sum(c.values()) for s, c in count.items()}
    ratio = lambda f: math.log((count[1][f] + 1) / total[1]) - math.log((count[-1][f] + 1) / total[-1])
    rows = [{f: ratio(f) / max(1, len(x)) ** 0.5 for f in x} for x in sets]
    upper = {1: 1.0, -1: y.count(1) / y.count(-1)}
    alpha, w, bias = [0.0] * len(y), collections.defaultdict(float), 0.0
    for _ in range(12):
        for i in rng.permutation(len(y)):
            gradient = y[i] * (sum(w[f] * v for f, v in rows[i].items()) + bias) - 1
            new = min(max(alpha[i] - gradient / (sum(v * v for v in rows[i].values()) + 1), 0.0), upper[y[i]])
            step, alpha[i] = (new - alpha[i]) * y[i], new
            for f, v in rows[i].items():
                w[f] += step * v
            bias += step
    return {f: v * ratio(f) for f, v in w.items()}, bias


def plain_scores(docs, labels):
    """Scores of {doc_id: text} by an NB-SVM fitted on {doc_id: label}; sigmoid by bisection."""
    sets = {i: plain_slots(t or "") for i, t in docs.items()}
    use = sorted((i for i in labels if i in docs and zlib.crc32(str(i).encode()) % 5), key=lambda i: (zlib.crc32(str(i).encode()), i))
    y, rng = [1 if labels[i] else -1 for i in use], np.random.default_rng(0)
    margin = lambda model, x: sum(model[0].get(f, 0.0) for f in x) / max(1, len(x)) ** 0.5 + model[1]
    folds = (np.arange(len(y)) % 3)[rng.permutation(len(y))].tolist()
    margins = [0.0] * len(y)
    for k in range(3):
        inside = [j for j in range(len(y)) if folds[j] != k]
        model = plain_svm([sets[use[j]] for j in inside], [y[j] for j in inside], rng)
        for j in range(len(y)):
            if folds[j] == k:
                margins[j] = margin(model, sets[use[j]])
    model = plain_svm([sets[i] for i in use], y, rng)
    slope, offset = quality._sigmoid(np.array(margins), np.array(y))
    return {i: 1 / (1 + math.exp(-(slope * margin(model, x) + offset))) for i, x in sets.items()}


def test_quality_query_equals_a_plain_classifier(spark, sf, texts):
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    expected = plain_scores(texts, labels)
    rows = quality.run(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert abs(r.score - expected[r.doc_id]) < 1e-6 and r.predicted == (r.score >= 0.3) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_quality_fit_is_bounded_when_ids_repeat(spark):
    docs = documents(spark, [(i % 3, f"text number {i}") for i in range(600)])
    labels = spark.createDataFrame([(i % 3, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    once = documents(spark, [(i % 3, f"text number {i}") for i in range(600)]).groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    model, same = quality.train(docs, labels), quality.train(once, labels)
    assert np.array_equal(model["w"], same["w"]) and model["bias"] == same["bias"]
    assert quality.score_documents(docs, model).count() == 600


# --- 6


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = {f for _, f in rows}
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for i, f in rows:
        k = find(f)
        least[k] = min((x for x in (least.get(k), i) if x is not None), default=None)
    return collections.Counter((i, f"{f:016x}", least[find(f)]) for i, f in rows)


def near(df):
    return df.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("f"), "component_id").collect()


def test_simhash_components(spark, texts):
    rng = random.Random(2)
    rows = list(texts.items())[:120]
    for i, (_, text) in enumerate(rows[:40]):
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((1000 + i, " ".join(words)))
    expected = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    assert collections.Counter(map(tuple, near(simhash.near_duplicates(documents(spark, rows))))) == expected


def test_simhash_edges(edge, none):
    expected = plain_components([(i, plain_fingerprint(t)) for i, t in EDGE])
    assert collections.Counter(map(tuple, near(simhash.near_duplicates(edge)))) == expected
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.keep_one(edge)
    assert kept.columns == edge.columns and kept.count() == len({c for _, _, c in expected})


@pytest.mark.parametrize(("crowd", "dense"), [(4096, 48), (20, 65), (3, 65), (20, 48), (20, 1)])
def test_simhash_crowds_are_linked_whole(spark, crowd, dense):
    """With 20 crowded keys are cut by further segments, with 3 those of them that stay crowded by balls;
    keys of dense groups by balls at once.
    """
    rng = random.Random(3)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(150)} | {rng.getrandbits(64) for _ in range(50)}
    fps |= {centre ^ (rng.getrandbits(20) << shift) for shift in (0, 22, 43) for _ in range(40)}
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fps]
    df = spark.createDataFrame(signed, "fp long").repartition(2)

    def groups(links):
        roots = dict(components(links).collect())
        return sorted(sorted(x for x in (f[0] for f in signed) if roots.get(x, x) == r) for r in {roots.get(f[0], f[0]) for f in signed})

    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in fps:
        for y in fps:
            if (x ^ y).bit_count() <= 4:
                root[find(x)] = find(y)
    plain = collections.defaultdict(list)
    for x in fps:
        plain[find(x)].append(x - (1 << 64) if x >> 63 else x)
    plain = sorted(sorted(g) for g in plain.values())
    assert 1 < len(plain) < len(fps)
    assert groups(simhash.links(df, crowd, dense)) == plain
    if crowd == 3:
        assert groups(simhash.balls(df)) == plain


def test_simhash_of_a_very_long_text(monkeypatch):
    text = " ".join(f"W{i % 977}" for i in range(70_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)
    monkeypatch.setattr(simhash, "BLOCK", 1000)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(5, 5), (None, 7)]
    found = dict(components(spark.createDataFrame(links, "a long, b long")).collect())
    assert found == {i: 0 for i in range(61)} | {100 + i: 100 for i in range(40)}


# --- 8


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(1500):
        x = [rng.randint(0, rng.choice([0, 1, 2, 5, 30])) for _ in range(rng.randint(0, 30))]
        assert suffix_array(x) == sorted(range(len(x)), key=lambda i: x[i:])


def plain_repeats(texts, length=200):
    raws = [(t or "").encode() for t in texts]
    met = collections.Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = bytearray(len(r) + 1)
        for p in range(len(r) - length + 1):
            if met[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(r)))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(r, gone, strict=False) if not g)).hexdigest()))
    return out


def passages():
    rng = random.Random(5)
    letters = ["é", "a", "b", "\n"]
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [some(rng.randint(150, 450)) for _ in range(20)]
    texts = []
    for _ in range(70):
        parts = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(shared)
            parts.append(p[rng.randint(0, 80) : len(p) - rng.randint(0, 80)] if rng.random() < 0.7 else some(rng.randint(1, 200)))
        texts.append("".join(parts))
    return [*texts, "ab" * 400, "x" * 1000, None, "", texts[3], texts[3], "y" * 199, "y" * 200]


@pytest.mark.parametrize("limits", [{}, {"crowd": 3}, {"filter_bits": 6}])
def test_repeats(spark, limits):
    texts = passages()
    df = documents(spark, list(enumerate(texts))).repartition(3)
    found = {r[0]: tuple(r[1:]) for r in repeats.remove_repeats(df, **limits).collect()}
    assert [found[i] for i in range(len(texts))] == plain_repeats(texts)


def test_repeats_of_a_long_text_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", 300)
    found = repeats.Anchors()
    raw = bytes(random.Random(7).choices(b"abc", k=2000))
    strings = [p for at, _, _, first, last in found(raw) for a, b in zip(first, last, strict=True) for p in range(at + a, at + b + 1)]
    assert strings == list(range(len(raw) - repeats.LENGTH + 1))


def test_repeats_edges(edge, none):
    assert repeats.remove_repeats(edge).count() == len(EDGE) and repeats.remove_repeats(none).count() == 0
    stripped = repeats.strip_repeats(edge)
    assert stripped.columns == edge.columns and stripped.count() == len(EDGE)
    assert [r.text for r in stripped.where("doc_id = 7").collect()] == [""]


# --- 3


def contained(rows, items):
    out = collections.Counter()
    for i, t in rows:
        words = decontaminate.WORDS.findall((t or "").lower())
        for j, u in items:
            q = decontaminate.WORDS.findall((u or "").lower())
            k = min(5, len(q))
            if k:
                want, have = decontaminate.shingles(q, k), decontaminate.shingles(words, k)
                if len(want & have) >= 0.8 * len(want):
                    out[i, j, len(want), len(want & have)] += 1
    return out


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_decontamination(spark, edge, none, limit):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    rows = [*EDGE, (20, f"before it {passage.upper()}, and after"), (21, passage.replace("seven", "x")), (22, "short item here"), (23, passage), (23, passage)]
    items = [(1, passage), (2, "Short item"), (3, None), (4, ""), (5, "the cat and the dog ran"), (1, passage), (6, "!!")]
    docs = documents(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("hash", F.lit(1))
    found = decontaminate.contained_items(docs, bench, broadcast_bytes=limit)
    assert collections.Counter((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in found.collect()) == contained(rows, items)
    assert decontaminate.contained_items(none, bench, limit).count() == 0
    assert decontaminate.contained_items(docs, bench.limit(0), limit).count() == 0
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.where("doc_id > 5").collect()) == [6, 7, 8, 9, 10, 21]


def test_items_that_repeat_and_share_a_signature_in_the_join(spark, monkeypatch):
    """Thousands of copies of an item and hundreds of items with one passage, beyond the broadcast's size."""
    monkeypatch.setattr(decontaminate, "TOGETHER", 16)
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
    items = [(7, passage)] * 3000 + [(i, f"{passage} and {i}") for i in range(100, 400)] + [(5, "the cat and the dog ran")]
    rows = [(1, f"so {passage} it goes"), (2, passage + " and 150"), (2, passage + " and 150"), (3, "nothing of that"), (None, passage)]
    found = decontaminate.contained_items(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"), broadcast_bytes=0)
    assert collections.Counter((r.doc_id, r.item_id, r.n_shingles, r.n_shared) for r in found.collect()) == contained(rows, items)


def test_items_are_partitioned_by_the_size_of_their_sets():
    rng = random.Random(4)
    sizes = [1, 2, 3, 7, 8, 40, 500, 1996]
    items = decontaminate.Items([(n, " ".join(f"w{rng.getrandbits(60)}" for _ in range(n + 4))) for n in sizes])
    assert set(items.keys) == {(5, int(math.log2(n))) for n in sizes}
    ceilings = items.partitions.ceilings[5]
    assert max(ceilings[b] for b in (8, 10)) < 0.3 * 2**64  # the large ones' hashes are the lowest fifth
    words = decontaminate.word_hashes(" ".join(f"v{rng.getrandbits(60)}" for _ in range(5000)))
    found = list(items.partitions.look(words))
    assert {band for _, band, _ in found} <= set(ceilings) and sum(len(h) for *_, h in found) < 200  # of 4,996
    few = decontaminate.word_hashes(" ".join(f"v{i}" for i in range(30)))
    assert all(band <= 5 for _, band, _ in items.partitions.look(few))


def test_very_long_texts_and_words_are_taken_whole(spark, monkeypatch):
    rng = random.Random(6)
    text = " ".join(rng.choice(["a", "éé", "x" * 700, "b1,c2", "—"]) for _ in range(400))
    whole = decontaminate.word_hashes(text).tolist()
    assert len(whole) == len(decontaminate.WORDS.findall(text.lower()))
    for size in (16, 64, 1000):
        monkeypatch.setattr(decontaminate, "BLOCK", size)
        assert decontaminate.word_hashes(text).tolist() == whole
    passage = "one two three four five six seven eight nine ten"
    rows = [(1, "y" * 1_500_000 + " " + passage), (2, "word " * 300_000 + passage), (3, "word " * 300_000)]
    found = decontaminate.contained_items(documents(spark, rows), spark.createDataFrame([(7, passage), (8, "y" * 1_500_000)], "item_id long, text string"))
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(1, 7), (1, 8), (2, 7)]


def test_the_fit_is_bounded_in_indicators(spark):
    """Of texts with very many indicators fewer are fitted on, in the order of their ids' hashes, and one of each class at least."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 3 + str(rng.getrandbits(20)) for _ in range(300))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    whole = quality.train(docs, labels)
    order = [r.id for r in spark.range(40).where(F.crc32(F.col("id").cast("string")) % 5 != 0).orderBy(F.xxhash64("id"), "id").collect()]
    extract = quality.Extractor()
    size = {i: len(extract(t)) for i, t in rows}
    for least in (0, sum(size[i] for i in [i for i in order if i % 2][:3])):
        used = set()
        for y in (0, 1):
            total = 0
            for n, i in enumerate([i for i in order if i % 2 == y]):
                total += size[i]
                if total <= least or not n:
                    used.add(i)
        some = quality.train(docs, labels, indicators=least)
        assert np.array_equal(some["w"], quality.train(docs.where(F.col("doc_id").isin(list(used))), labels)["w"]) and not np.array_equal(some["w"], whole["w"])
    assert np.array_equal(quality.train(docs, labels, indicators=10**9)["w"], whole["w"])


# --- 4


def plain_signatures(text):
    words = [w for w in re.sub(r"[\W_]+", " ", (text or "").lower()).strip().split(" ") if w]
    common = set(spotsigs.ANCHORS)
    content = [(i, w) for i, w in enumerate(words) if w not in common]
    found, k = set(), 0
    for i, w in enumerate(words):
        if w in common:
            while k < len(content) and content[k][0] < i:
                k += 1
            if len(content) - k >= 2:
                found.add((w, content[k][1], content[k + 1][1]))
    return found or ({("all", " ".join(words))} if words else set())


def plain_jaccard(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def check_fingerprints(rows, found):
    distinct = sorted(set(rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (i, text) in enumerate(distinct):
        text, after = text or "", distinct[(k + 1) % len(distinct)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        for r in (r for r in found if r.doc_id == i):
            assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert r.near_edited == pytest.approx(plain_jaccard(plain_signatures(text), plain_signatures(edited)))
            assert r.near_next == pytest.approx(plain_jaccard(plain_signatures(text), plain_signatures(after)))
            assert len(r.fingerprint) == 16 * len(plain_signatures(text))


def test_fingerprints(spark, texts, edge, none):
    rows = list(texts.items())[:80]
    found = spotsigs.fingerprints(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    check_fingerprints(rows, found)
    found = spotsigs.fingerprints(edge).collect()
    assert len(found) == len(EDGE) and spotsigs.fingerprints(none).count() == 0
    check_fingerprints(EDGE, found)
    far = [(-(1 << 63), "of the lowest id there is"), (0, "an id of zero beside no id at all"), (None, "an id of zero beside no id at all"), ((1 << 63) - 1, "the dog and a cat " * 30_000)]
    found = spotsigs.fingerprints(documents(spark, far)).collect()
    assert {r.doc_id for r in found} == {i for i, _ in far}
    check_fingerprints(far, found)


def test_fingerprints_of_rows_that_repeat_very_often(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "ALIKE", 3)
    rows = [(i % 7, f"the house {i % 3} and a long road to the sea") for i in range(42)] + [(9, "of all the rows this one comes most often")] * 25
    found = spotsigs.fingerprints(documents(spark, rows).repartition(5)).collect()
    assert collections.Counter((r.doc_id, r.n_chars) for r in found) == collections.Counter((i, len(t)) for i, t in rows)
    assert len({(r.fingerprint, r.near_next, r.edited_sha256) for r in found if r.doc_id == 9}) == 1


def test_similar_texts(spark, texts):
    rows = list(texts.items())[:60]
    rows += [(1000 + i, " ".join(t.split(" ")[:-3])) for i, t in rows[:20]]
    docs = documents(spark, rows)
    name = {r.name: r.doc_id for r in spotsigs.class_of(docs).collect()}
    found = {tuple(sorted((name[r.a], name[r.b]))) for r in spotsigs.similar_texts(docs).collect()}
    sets = {i: plain_signatures(dict(rows)[i]) for i in name.values()}
    expected = {(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and plain_jaccard(sets[a], sets[b]) >= 0.8}
    assert found == expected and expected


# --- 9


def test_sharding(edge, none):
    names = sharding.shard_names(7)
    filled = sharding.fill(names, 101)
    assert set(collections.Counter(filled).values()) <= {14, 15}
    # Slot by slot: each shard in turn takes the first free slot of its list.
    free, lists, expected = set(range(101)), [], [None] * 101
    for n in names:
        first, stride = sharding.preferences(n, 101)
        lists.append(iter([(first + j * stride) % 101 for j in range(101)]))
    while free:
        for k, own in enumerate(lists):
            if free:
                expected[slot := next(s for s in own if s in free)] = k
                free.remove(slot)
    assert filled == expected
    moved = sum(a != b for a, b in zip(filled, sharding.fill(names[:-1], 101), strict=True))
    assert moved < 40
    placed = sharding.place(edge, F.col("doc_id"), names, 101)
    rows = placed.collect()
    assert len(rows) == len(EDGE) and len({r.shard for r in rows if r.doc_id == 3}) == 1
    for r in rows:
        key = "" if r.doc_id is None else str(r.doc_id)
        assert r.slot == int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101 and r.shard == names[filled[r.slot]]
    assert sharding.place(none, F.col("doc_id"), names, 101).count() == 0
    for name in ("slot", "shard"):  # a key called like the output
        named = edge.select(F.col("doc_id").alias(name))
        assert collections.Counter(sharding.place(named, F.col(name), names, 101).select("slot", "shard").collect()) == collections.Counter(placed.select("slot", "shard").collect())
    with pytest.raises(ValueError):
        sharding.fill(names, 100)


def test_vocabulary_is_not_in_the_repository():
    assert json.load(open(TOKENIZER, encoding="utf-8"))["model"]["merges"] and "spanweave" not in TOKENIZER
