"""The pipeline stage by stage against brute force, and the registered queries."""

import math
import os

import duckdb
import pytest
import xxhash

import __spark_entry__ as E
import corpus_pipeline
from jobstar.llm import quality
from jobstar.llm.queries import ORACLE, QUERIES
from tests.llm import brute
from tests.llm.test_text_ops import _checked

SF = "/root/testdata/sf0.001"


def _hash(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64_intdigest(data, seed=seed)


def _buckets(words: list[str]) -> list[int]:
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    single = [_hash(w.encode()) for w in words]
    raw = [x.to_bytes(8, "little") for x in single]
    pair = [_hash(b, _hash(a)) for a, b in zip(raw, raw[1:])]
    return [signed(x) % quality.BUCKETS for x in single + pair]


def _scores(docs: dict, trusted: set) -> dict:
    raw, target = [1.0] * quality.BUCKETS, [0.0] * quality.BUCKETS
    grams = {d: _buckets(brute.words(t)) for d, t in docs.items()}
    for d, found in grams.items():
        for b in found:
            raw[b] += 1
            target[b] += d in trusted
    n = sum(raw)
    share = [r / n for r in raw]
    total = sum(target) + quality.BUCKETS
    ratio = [math.log((t + quality.BUCKETS * p) / total / p) for t, p in zip(target, share)]
    return {d: sum(ratio[g] for g in found) / len(found) if found else 0.0 for d, found in grams.items()}


def test_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact", "near", "substrings", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    now = {r.doc_id: r.text for r in docs.collect()}
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    results = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        results.append(docs.collect())
    for out in results[:-1]:
        assert set(out[0].asDict()) == set(columns)
    # quality
    score = _scores(now, trusted)
    clear = lambda d: abs(score[d] - quality.THRESHOLD) > 1e-6  # noqa: E731  apart from rounding
    expected = {d for d, t in now.items() if not brute.base_rules(t)[-1] and score[d] >= quality.THRESHOLD}
    got = {r.doc_id for r in results[0]}
    assert {d for d in got if clear(d)} == {d for d in expected if clear(d)} and 0 < len(got) < len(now)
    # exact
    now = {d: now[d] for d in got}
    now = {d: now[d] for d, e in brute.exact(list(now.items())).items() if e[2]}
    assert {r.doc_id for r in results[1]} == set(now)
    # near
    now = {d: now[d] for d, e in brute.near(list(now.items()), 5, 80).items() if e[2]}
    assert {r.doc_id for r in results[2]} == set(now)
    # substrings
    listed = sorted(now.items())
    kept = brute.repeated_bytes(listed)
    now = {listed[k][0]: v[3].decode("utf-8", "ignore") for k, v in kept.items()}
    assert {r.doc_id: (r.text, r.n_chars) for r in results[3]} == {d: (t, len(t)) for d, t in now.items()}
    # packing
    used, least = _checked(list(now.items()), results[4])
    assert used <= least + 1


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_registered():
    assert sorted(QUERIES) == sorted(f"op{i}_{n}" for i, n in enumerate(
        ["exact_dedup", "warc", "quality", "fm_index", "packing", "bpe", "minhash", "toxicity", "langid", "suffix_array",
         "merge_automaton", "laesa", "era_phrases"], 1))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF).select(*columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_every_document_has_rows(spark, name):
    table, key = ("pages", "page_id") if name == "op2_warc" else ("documents", "doc_id")
    ids = {r[0] for r in spark.read.parquet(os.path.join(SF, f"{table}.parquet")).select(key).collect()}
    out = [r[key] for r in QUERIES[name](spark, SF).collect()]
    assert set(out) == ids and (name == "op5_packing" or len(out) == len(ids))
