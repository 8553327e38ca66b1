"""Every stage of the pipeline against a plain version of its decision."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from reelrank.llm import toxicity
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_line_dedup import brute as line_brute
from tests.llm.test_simhash import brute_components, brute_fingerprint


@pytest.fixture(scope="module")
def stages(spark, sf_small, tmp_path_factory):
    """Rows before and after each stage, by name."""
    root, docs, out = tmp_path_factory.mktemp("pipeline"), spark.read.parquet(f"{sf_small}/documents.parquet"), {}
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, sf_small).write.parquet(str(root / name))
        docs = spark.read.parquet(str(root / name))
        out[name] = before.collect(), docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == first
    return out


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "byte_bpe"]


def test_toxicity(spark, sf_small, stages):
    before, after = stages["toxicity"]
    docs, labels = (spark.read.parquet(f"{sf_small}/{t}.parquet") for t in ("documents", "labels"))
    grammar = toxicity.fit(docs, labels)
    score = lambda t: float(grammar.score(np.array([grammar.features(t)[:3]]))[0])
    assert sorted(after) == sorted(r for r in before if score(r["text"]) < 0.3)


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    want = {}
    for doc_id, (lines, gone, _, kept) in line_brute([(r["doc_id"], r["text"]) for r in before], 2, 10).items():
        if not gone or gone < lines:
            want[doc_id] = kept
    assert {r["doc_id"]: r["text"] for r in after} == want
    chars = {r["doc_id"]: r for r in before}
    for r in after:
        same = chars[r["doc_id"]]["text"] == r["text"]
        assert r["n_chars"] == (chars[r["doc_id"]]["n_chars"] if same else len(r["text"]))


def test_simhash(stages):
    before, after = stages["simhash_near_dedup"]
    ids = [r["doc_id"] for r in before]
    groups = brute_components(ids, [brute_fingerprint(r["text"]) for r in before], 4)
    assert sorted(after) == sorted(r for r in before if groups[r["doc_id"]] == r["doc_id"])


def test_decontamination(spark, sf_small, stages):
    before, after = stages["benchmark_decontamination"]
    bench = [tuple(r) for r in spark.read.parquet(f"{sf_small}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in before], bench)}
    assert dirty and sorted(after) == sorted(r for r in before if r["doc_id"] not in dirty)


def test_bpe(stages):
    before, after = stages["byte_bpe"]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r["doc_id"]: r["text"] or "" for r in before}
    assert sorted(r["doc_id"] for r in after) == sorted(texts)
    for r in after:
        assert list(r["ids"]) == reference.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_empty_documents(spark, sf_small):
    empty = spark.read.parquet(f"{sf_small}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_small).count() == 0
