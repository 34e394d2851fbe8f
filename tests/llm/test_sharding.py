"""Minimax contiguous shards against a plain search."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from aerolap.llm import sharding


def least_capacity(sizes, shards):
    def fits(c):
        n, now = 1, 0
        for s in sizes:
            if s > c:
                return False
            if now + s > c:
                n, now = n + 1, 0
            now += s
        return n <= shards
    lo, hi = 0, sum(sizes)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if fits(mid) else (mid, hi)
    return hi


@pytest.mark.parametrize("seed,bins", [(1, 4), (2, 16), (3, 4096), (4, 3)])
def test_capacity_is_the_smallest(spark, seed, bins):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 5, 50, rng.randint(1, 400)]) for _ in range(rng.choice([3, 40, 500]))]
    df = spark.createDataFrame(list(enumerate(sizes)), "i bigint, s bigint")
    prefix = sharding.prefix_sums(df, ["i"], "s").cache()
    assert sorted((r["i"], r["end"]) for r in prefix.collect()) == \
        [(i, sum(sizes[: i + 1])) for i in range(len(sizes))]
    for shards in (1, 2, 8):
        capacity, cuts = sharding.smallest_capacity(prefix, "s", shards, bins=bins)
        assert capacity == least_capacity(sizes, shards)
        assert cuts[-1] == sum(sizes) and max(b - a for a, b in zip([0, *cuts], cuts)) <= capacity


def check(rows, docs):
    sizes, slots, homes = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in rows:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        homes[(r["size"], r["text_crc32"])].add(r["shard"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in homes.values())
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in rows) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    return sizes


def test_shards_hold_groups_and_are_even(make_docs):
    rng = random.Random(5)
    docs = [(i, rng.choice(["copy " * 30, None, "", "é" * rng.randint(1, 200), f"text {i}" * rng.randint(1, 40)]))
            for i in range(400)]
    sizes = check(sharding.shard(make_docs(docs)).collect(), docs)
    groups = {}
    for i, t in docs:
        first, size = groups.get(t or "", (i, 0))
        groups[t or ""] = (min(first, i), size + len((t or "").encode()) + 1)
    assert max(sizes.values()) == least_capacity([s for _, s in sorted(groups.values())], 8)


def test_awkward_and_empty(awkward, empty):
    docs = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    check(sharding.shard(awkward).collect(), docs)
    assert sharding.shard(empty).collect() == []
