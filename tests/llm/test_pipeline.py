"""The stages against brute-force versions of the operators, and the queries
against their SQL on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from aerolap.llm import quality  # noqa: E402
from aerolap.llm.queries import ORACLE, QUERIES  # noqa: E402
from .test_dedup import brute_classes, brute_lines, brute_repeats, WORDS  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = quality.judge(docs, quality.train(docs, labels)).collect()
    rows = [(r["doc_id"], r["text"]) for r in judged if r["kept"]]
    assert 0 < len(rows) < len(judged)
    rows = [(i, t) for i, (_, _, t) in brute_lines(rows).items()]
    classes = brute_classes(rows, 5, 80, 100)
    rows = [(i, t) for i, t in rows if classes[i][1] == i]
    cut = brute_repeats(rows)

    got = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, SF)
        assert got.columns == docs.columns, name
    got = got.cache()
    words = {r["doc_id"]: " ".join(WORDS.findall(r["text"] or "")) for r in got.collect()}
    assert words == {i: t for i, (_, _, t) in cut.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.collect() if r["doc_id"] in cut and cut[r["doc_id"]][1])

    packed = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in packed} == set(words)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in packed)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert (s2 == s and o2 == o + n) or (s2 > s and o2 == 0)
        assert o + n <= 1024
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(want.fetchall(), key=key)


def test_results_have_the_agreed_columns(spark):
    agreed = {
        "op1_ann": "query_id:bigint rank:int vec_id:bigint score:double",
        "op3_packing": "doc_id:bigint piece:int start:bigint length:bigint ids_crc32:bigint sequence_id:bigint "
                       "offset:bigint",
        "op4_quality_rules": "doc_id:bigint n_words:bigint word_chars:bigint n_symbols:bigint n_dup_lines:bigint "
                             "n_repeat_words:bigint base_failed:boolean kept:boolean",
        "op5_html_extraction": "page_id:bigint url:string text:string n_chars:bigint",
        "op6_bpe": "doc_id:bigint n_tokens:bigint ids_sha256:string decoded_sha256:string",
        "op7_near_dedup": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
        "op10_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint "
                         "grown_shard:int"}
    for name, want in agreed.items():
        assert " ".join(f"{c}:{t}" for c, t in QUERIES[name](spark, SF).dtypes) == want, name
