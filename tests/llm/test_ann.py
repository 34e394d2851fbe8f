"""Recall and scores against brute force, and awkward vectors."""

from __future__ import annotations

import numpy as np
import pytest

from aerolap.llm.ann import BlockIndex, nearest


def brute(ids, vectors, query_id, query, k):
    s = (vectors * query).sum(axis=1)
    order = np.lexsort((ids, -s))
    return [(int(ids[i]), s[i]) for i in order if ids[i] != query_id][:k]


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label string, v string, block string")


def test_recall_and_scores_on_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = df.toPandas()
    ids, vectors = pdf.vec_id.to_numpy(), np.stack(pdf.embedding.to_numpy()).astype(float)
    out = nearest(df, df.where("vec_id % 20 = 0"), k=20).toPandas()
    hits = []
    for q, found in out.groupby("query_id"):
        found = found.sort_values("rank")
        at = {int(i): n for n, i in enumerate(ids)}
        want = brute(ids, vectors, q, vectors[at[q]], 20)
        assert found["rank"].tolist() == list(range(1, 21))
        exact = [float((vectors[at[i]] * vectors[at[q]]).sum()) for i in found.vec_id]
        assert found.score.to_numpy() == pytest.approx(exact, abs=1e-12)
        assert sorted(zip(-found.score, found.vec_id)) == list(zip(-found.score, found.vec_id))
        hits.append(len({i for i, _ in want} & set(found.vec_id)) / 20)
    assert len(hits) == int((ids % 20 == 0).sum()) and np.mean(hits) >= 0.9


def test_recall_on_full_blocks(spark):
    """Two blocks of BLOCK_ROWS vectors, of which about a tenth is verified."""
    from aerolap.llm.ann import BLOCK_ROWS

    rng = np.random.default_rng(11)
    centres = rng.normal(size=(200, 64))
    vectors = centres[rng.integers(0, 200, size=2 * BLOCK_ROWS)] + 0.7 * rng.normal(size=(2 * BLOCK_ROWS, 64))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    ids = np.arange(len(vectors))
    df = spark.createDataFrame(list(zip(ids.tolist(), vectors.tolist())), "vec_id bigint, embedding array<float>")
    vectors = vectors.astype(float)
    out, hits = nearest(df, df.where("vec_id % 100 = 0"), k=20).toPandas(), []
    for q, found in out.groupby("query_id"):
        want = brute(ids, vectors, q, vectors[np.flatnonzero(ids == q)[0]], 20)
        hits.append(len({i for i, _ in want} & set(found.vec_id)) / 20)
    assert len(hits) == int((ids % 100 == 0).sum()) and np.mean(hits) >= 0.95


def test_several_blocks_and_unequal_norms(spark, monkeypatch):
    from aerolap.llm import ann

    monkeypatch.setattr(ann, "BLOCK_ROWS", 300)
    monkeypatch.setattr(ann, "QUERY_ROWS", 16)
    rng = np.random.default_rng(1)
    vectors = (rng.normal(size=(1500, 16)) * rng.uniform(0.2, 3, size=(1500, 1))).astype(np.float32)
    df = table(spark, [(i, v.tolist(), None, "x", "x") for i, v in enumerate(vectors)])
    out = nearest(df, df.where("vec_id % 20 = 0"), k=10).toPandas()
    wide, hits = vectors.astype(float), []
    for q, found in out.groupby("query_id"):
        want = brute(np.arange(1500), wide, q, wide[q], 10)
        hits.append(len({i for i, _ in want} & set(found.vec_id)) / 10)
    assert np.mean(hits) >= 0.9


def test_a_very_common_vector_ties_to_smaller_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.5, 0.25], None, "x", "x") for i in range(1000, 2200)]
    rows += [(i, rng.normal(size=3).tolist(), None, "x", "x") for i in range(300)]
    df = table(spark, rows)
    out = nearest(df, df.where("vec_id = 1040"), k=20).orderBy("rank").collect()
    scores = [(1.0, 0.5, 0.25)] and {r["vec_id"]: r["score"] for r in out}
    same = [r["vec_id"] for r in out if abs(r["score"] - 1.3125) < 1e-12]
    assert same == sorted(same) and set(same) <= {*range(1000, 1021)}
    assert len(scores) == 20 and 1040 not in scores


def test_awkward_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]),
            (5, [inf, 1.0]), (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (1, [1.0, 1.0]),
            (40, None)]
    df = table(spark, [(*r, None, "x", "x") for r in rows])
    out = nearest(df, df.where("vec_id % 20 = 0"), k=20).collect()
    got = {}
    for r in sorted(out, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(1, 1.0), (1, 1.0), (20, 0.0)], 20: [(1, 1.0), (1, 1.0), (0, 0.0)]}
    for small in (df.limit(0), df.where("vec_id = 2"), df.where("vec_id = 0")):
        assert nearest(small, small).collect() == []


def test_windows_end_when_a_block_is_covered():
    index = BlockIndex(np.arange(30), np.random.default_rng(3).normal(size=(30, 4)), 40.0, 16)
    rows, scores, _ = index.search(-1, np.ones(4), 50, 1000)
    assert len(rows) == 30 and (np.diff(scores) <= 0).all()


def test_repeated_query_rows_are_one_query(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)], "x", "x", "x") for i in range(200)]
    out = nearest(table(spark, rows), table(spark, [rows[0], rows[0], rows[7]]), k=20).toPandas()
    for _, found in out.groupby("query_id"):
        assert len(found) == 20 and found.vec_id.nunique() == 20
    assert set(out.query_id) == {0, 7}
