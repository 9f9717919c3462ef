"""The pipeline, stage by stage, against what each stage promises."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as p
from landspark.llm.common import materialize
from tests.llm.helpers import LONG, awkward
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash import jaccard, united

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before, kept = docs.columns, docs.collect(), []
    for name, stage in p.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        kept.append(docs.collect())
    language, near, clean, mix = kept
    assert len(language) == len(before)  # all are in learned languages

    texts = [" ".join(r["text"].lower().split()) for r in language]
    groups = united(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if jaccard(texts[a], texts[b]) >= 0.8])
    assert sorted(r["doc_id"] for r in near) == sorted({min(language[k]["doc_id"] for k in range(len(texts)) if groups[k] == g) for g in set(groups)})

    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").collect()]
    hit = {i for i, _ in brute([r["text"] for r in near], items)}
    assert sorted(r["doc_id"] for r in clean) == sorted(r["doc_id"] for k, r in enumerate(near) if k not in hit) and hit

    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(mix) - 1.5 * words(clean)) <= 20  # a rounded word for each source

    out = materialize(p.STAGES[-1][1](spark, docs, SF), "tokens").orderBy("start").collect()
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for r, d in zip(out, sorted(mix, key=lambda d: (d["doc_id"], d["text"])), strict=True):
        ids = np.array([*tokenizer.encode(d["text"], add_special_tokens=False).ids, 1], "<u4")
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (d["doc_id"], at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in p.STAGES:
        docs = materialize(stage(spark, docs, SF), "stage")
    assert docs.count() == 0


def test_awkward_rows(spark):
    """Nulls, blanks, very long texts, repeats and clashing names go through every stage."""
    docs, n = awkward(spark), []
    columns = docs.columns
    for _, stage in p.STAGES[:-1]:
        docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == columns
        n.append(docs.collect())
    language, near, clean, mix = n
    assert {r["doc_id"] for r in language}.isdisjoint({2, 3, 4, 9}) and {r["doc_id"] for r in language} >= {1, 5, 6, 7}
    texts = {r["text"] for r in language}
    assert sorted(r["text"] for r in near) == sorted(texts) and [r["doc_id"] for r in near if r["text"] == LONG] == [5]
    assert sorted(map(str, clean)) == sorted(map(str, near))  # none has a passage of the benchmark
    words = lambda rows: sum(len(r["text"].split()) for r in rows)
    assert abs(words(mix) - 1.5 * words(clean)) <= 3
    out = materialize(p.STAGES[-1][1](spark, docs, SF), "tokens")
    assert out.count() == len(mix)


def test_columns_named_like_helpers_come_through(spark):
    extra = ("_near_1", "_near_2", "_bench_1", "_mix_1", "_mix_row", "_mix_words")
    docs = awkward(spark).selectExpr("*", *[f"concat('v', doc_id) AS {c}" for c in extra])
    columns = docs.columns
    for name, stage in p.STAGES[1:-1]:
        docs = materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name
        assert all(r[c] == (None if r["doc_id"] is None else f"v{r['doc_id']}") for r in docs.collect() for c in extra), name
