"""Exact top-k against brute force, with awkward vectors."""

from __future__ import annotations

import math

import numpy as np
import pytest

from aerolap.llm import pivot_search
from aerolap.llm.pivot_search import Index, scan, top_k

SCHEMA = "vec_id bigint, embedding array<double>, v string, key string, block string, id string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x", None, "x", "x") for i, v in rows], SCHEMA)


def integers(v, width):
    out = [math.floor(256 * x) for x in v]
    return tuple(out + [0] * (width - len(out)))


def brute(vectors, queries, k):
    """{query_id: [(vec_id, score)]} over distinct rows; a row is no candidate
    for itself, a candidate's score is its best over the query's rows."""
    usable = lambda rows: [(i, v) for i, v in rows if i is not None and v is not None
                           and all(x is not None and math.isfinite(x) for x in v)]
    width = max([len(v) for _, v in usable(vectors) + usable(queries)], default=0)
    all_ = {(i, integers(v, width)) for i, v in usable(vectors)}
    found = {}
    for q, a in {(i, integers(v, width)) for i, v in usable(queries)}:
        for c, b in all_:
            if (q, a) != (c, b):
                s = sum(x * y for x, y in zip(a, b))
                best = found.setdefault(q, {})
                best[c, b] = max(best.get((c, b), s), s)
    return {q: sorted((-s, c) for (c, _), s in best.items())[:k] for q, best in found.items()}


def check(spark, vectors, queries, k):
    out = top_k(table(spark, vectors), table(spark, queries), k=k)
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    want = {q: [(n, *x) for n, x in enumerate(rows, 1)] for q, rows in brute(vectors, queries, k).items() if rows}
    assert {q: sorted(rows) for q, rows in got.items()} == want


def some(n, width, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(7, width))
    at = rng.integers(0, 7, size=n)
    return [(int(i), [float(x) for x in row])
            for i, row in enumerate(centres[at] + spread * rng.normal(size=(n, width)))]


def test_clusters_in_many_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivot_search, "BLOCK_BYTES", 0)          # 256 rows a block
    monkeypatch.setattr(pivot_search, "SLICE", 16)
    monkeypatch.setattr(pivot_search, "STEP", 8)
    monkeypatch.setattr(pivot_search, "PART_QUERIES", 20)
    rows = some(1500, 6, 3, spread=0.05)
    check(spark, rows, [r for r in rows if r[0] % 20 == 0], 5)


def test_copies_ties_and_repeated_rows(spark):
    rows = [(i, [0.5, 0.25]) for i in range(40)] + [(i, [1.0, -1.0]) for i in range(40, 44)]
    rows += [(3, [0.5, 0.25])] * 30 + [(5, [0.9, 0.9]), (5, [0.8, 0.8]), (41, [0.5, 0.25]), (60, [0.0, 0.0])]
    check(spark, rows, rows, 5)


def test_unusable_unequal_and_few(spark):
    rows = [(1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [1.0, 1.0]),
            (5, [1.0]), (6, [1.0, 2.0, 3.0]), (7, []), (8, [-0.001, 0.0]), (-100, [0.3, 0.4])]
    check(spark, rows, rows, 5)
    check(spark, rows[:6], rows[:6], 5)                          # one usable vector: no candidates


def test_large_integers_are_exact(spark):
    rows = [(i, [float(3 * 2 ** 18 + i), 2.0 ** 17 - i / 256]) for i in range(30)]
    check(spark, rows, rows[:10], 5)
    with pytest.raises(ValueError):
        top_k(table(spark, [(1, [2.0 ** 40])]), table(spark, [(1, [1.0])]))


def test_empty_tables(spark):
    none, one = table(spark, []), table(spark, [(1, [1.0, 2.0])])
    for a, b in ((none, none), (one, none), (none, one)):
        out = top_k(a, b)
        assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_slices_beyond_the_radius_are_skipped():
    """The scan reads few of the entries when a good score is known."""
    v = np.array([x for _, x in some(4000, 3, 9, spread=0.01)])
    v = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None])
    top = float((v ** 2).sum(axis=1).max())
    index = Index(np.zeros((1, 4)), top, 3)
    index.pivots = index.lifted(v[:1])
    dist = index.distances(index.lifted(v))[:, 0]
    order = np.argsort(dist)
    v, dist = v[order], dist[order]
    query = v[:1]
    d = index.distances(np.column_stack([query, [[0.0]]]))[:, 0]
    scores = v @ query[0]
    kth = np.sort(scores)[-6]
    seen = []

    class Spy(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                seen.append(at.start)
            return np.asarray(super().__getitem__(at))

    q, e, s = scan(v.view(Spy), np.arange(len(v)), dist, query, d, np.array([float(kth)]), 6, index, np.float64)
    assert sorted(s.tolist()) == sorted(scores[scores >= kth].tolist())[-6:]
    assert 0 < len(seen) < len(v) / pivot_search.SLICE
