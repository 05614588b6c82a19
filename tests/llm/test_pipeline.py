"""The corpus pipeline against brute force, and on tables it is not used to."""

import collections
import gc
import hashlib
import os
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.functions import lit
from test_text_operators import EDGE, contained, passages, plain_components, plain_fingerprint, plain_repeats, plain_scores

import corpus_pipeline
from spanweave.llm import bpe, repeats, simhash
from spanweave.llm.common import map_batches, table
from spanweave.llm.registry import TOKENIZER


def plain_kept(texts):
    """Texts without the bytes of strings that repeat; a character that is cut goes whole."""
    raws = [(t or "").encode() for t in texts]
    met = collections.Counter(r[p : p + 200] for r in raws for p in range(len(r) - 199))
    for r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - 199):
            if met[r[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        yield bytes(b for b, g in zip(r, gone, strict=True) if not g).decode("utf-8", "ignore")


def plain_pipeline(texts, labels, items):
    from tokenizers import Tokenizer

    scores = plain_scores(texts, labels)
    docs = [(i, t) for i, t in texts.items() if scores[i] >= 0.3]
    groups = plain_components([(i, plain_fingerprint(t)) for i, t in docs])
    firsts = {c for _, _, c in groups}
    docs = [(i, t) for i, t in docs if i in firsts]
    docs = list(zip([i for i, _ in docs], plain_kept([t for _, t in docs]), strict=True))
    dirty = {i for i, *_ in contained(docs, items)}
    library = Tokenizer.from_file(TOKENIZER)
    out = {}
    for i, t in docs:
        if i not in dirty:
            ids = library.encode(t, add_special_tokens=False).ids
            out[i] = len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()
    return out


def test_pipeline_equals_brute_force(spark, sf):
    texts = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    expected = plain_pipeline(texts, labels, items)
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, sf).collect()}
    assert found == expected and 50 < len(found) < len(texts)


def test_stripped_texts_equal_brute_force(spark):
    texts = passages()
    assert [r[1] for r in plain_repeats(texts)].count(0) < len(texts)
    found = dict(repeats.strip_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [found[i] or "" for i in range(len(texts))] == list(plain_kept(texts))


@pytest.mark.parametrize("rows", [EDGE, []])
def test_pipeline_of_odd_tables(spark, tmp_path, rows):
    def write(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))

    more = [(*r, "en", "web", len(r[1] or ""), 1, 2, 3) for r in rows]
    write("documents", more, "doc_id long, text string, lang string, source string, n_chars long, score long, __key long, anchor long")
    write("labels", [(3, 1, 0), (8, 0, 1), (None, None, None)] if rows else [], "doc_id long, quality int, toxic int")
    write("benchmark", [(1, None), (2, ""), (3, "the cat and the dog ran"), (None, "x")] if rows else [], "item_id long, text string")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len(found) <= len(rows) and all(r.doc_id in {i for i, *_ in rows} for r in found)
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_a_later_stage_does_not_hold_the_vocabulary(spark):
    """Spark uses Python workers again, and what the encoder kept in one is not for other operators' tasks to carry."""
    model = Path(TOKENIZER).read_text(encoding="utf-8")

    def say(encode):
        def make():
            encoder = bpe.load(model) if encode else None

            def step(batch):
                held = sum(isinstance(x, bpe.TrieBpe) for x in gc.get_objects())
                return pa.RecordBatch.from_arrays([pa.array([os.getpid()], pa.int64()), pa.array([held], pa.int64())], ["pid", "held"])

            return lambda batch: (encoder, step(batch))[1]

        return {(r["pid"], r["held"]) for r in map_batches(spark.range(0, 64, 1, 4), make, "pid long, held long").collect()}

    before, after = say(True), say(False)
    assert {held for _, held in before} == {1}
    assert {pid for pid, _ in before} & {pid for pid, _ in after}, "no worker was used again"
    assert {held for _, held in after} == {0}


def test_documents_without_an_id_stay_apart(spark, tmp_path):
    """Of several null ids each text stays once; equal texts, and those one bit from another, are one."""
    text = lambda word: " ".join(f"{word}{i} {word[::-1]}{i * 7} went." for i in range(60))
    rows = [(None, text("river")), (None, text("stone")), (None, text("cloud")), (None, text("stone")), (5, text("house")), (5, text("house")), (7, text("cloud")), (None, None), (None, ""), (8, text("paper")), (3, text("paper"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: lit(c) for c in ("root", "kept", "none", "fp")}).repartition(3)
    kept = simhash.keep_one(df)
    found = collections.Counter((r.doc_id, r.text or "") for r in kept.collect())
    assert kept.columns == df.columns
    assert found == collections.Counter([(None, text("river")), (None, text("stone")), (5, text("house")), (7, text("cloud")), (None, ""), (3, text("paper"))])
    docs = [(*r, "en", "web", len(r[1] or "")) for r in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    said = collections.Counter((r.doc_id, r.decoded_sha256) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert said == collections.Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in found.elements())
