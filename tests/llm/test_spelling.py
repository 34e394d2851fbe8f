"""Spelling variants against a plain search over all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from aerolap.llm.queries import misspelt
from aerolap.llm.spelling import count_words, near_pairs, pivots, runs, variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=5):
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def frame(spark, n):
    return spark.createDataFrame([(w, c, "x", 1) for w, c in n.items()], "word string, n bigint, gram string, size int")


def test_pivots_are_the_cheapest_disjoint_bigrams():
    rng = random.Random(4)
    for _ in range(300):
        grams = [(i, rng.randrange(9)) for i in sorted(rng.sample(range(12), 3))]
        cost = dict(grams)
        options = [(cost[a] + cost[b], (a, b)) for a in cost for b in cost if b - a >= 2]
        chosen = pivots(grams)
        assert chosen[1] - chosen[0] >= 2 and sum(cost[i] for i in chosen) == min(options)[0]


@pytest.mark.parametrize("letters, length", [("ab", 6), ("abc", 5), ("aeé\U0001f600", 4)])
def test_every_pair_of_a_dense_vocabulary(spark, letters, length):
    rng = random.Random(length)
    n = {}
    while len(n) < 300 and len(n) < len(letters) ** length:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(length - 1 if length > 4 else 4, length + 1)))
        n[w] = rng.choice([5, 6, 30, 150, 800, 4000])
    got = {(r.a, r.b) for r in near_pairs(frame(spark, n)).collect()}
    assert got == {(a, b) for a in n for b in n if a < b and one_edit(a, b)}
    assert {tuple(r) for r in variants(frame(spark, n)).collect()} == brute(n)


def test_chains_of_forms(spark):
    words = ["aaaaaa" + "b" * i for i in range(9)]
    n = {w: 5 * 6 ** i for i, w in enumerate(words)}
    got = {r.word: r.root for r in variants(frame(spark, n)).collect()}
    assert set(got.values()) == {words[-1]}


def test_awkward_words(spark):
    n = spark.createDataFrame([("letter", 5), ("letter", 9), ("lettre", None), (None, 7), ("lettera", 60)],
                              "word string, n bigint")
    got = {tuple(r) for r in variants(n).collect()}
    assert got == {("letter", "lettera", "lettera", 9, 1, 60), ("lettera", None, "lettera", 60, 1, None)}
    assert variants(n.where("false")).count() == 0
    with pytest.raises(Exception, match="four letters"):
        variants(spark.createDataFrame([("abc", 9)], "word string, n bigint")).collect()


def test_runs_and_counts_of_whole_texts(spark, make_docs):
    rng = random.Random(2)
    stock = ["Élévation", "straßenbahn", "MACHINERY", "machinery", "abcdefg", "short", "naïveté×÷word", "ÀÀÀÀÀÀ"]
    rows = [(i, rng.choice([" ", "1", "_", "漢", "-"]).join(rng.choice(stock) for _ in range(200))) for i in range(40)]
    rows += [(None, "machinery " * 300), (50, None), (51, ""), (52, "x" * 50000), (1, rows[1][1])]
    want = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            want[run] += 1
    want = {w: c for w, c in want.items() if len(w) >= 6 and c >= 5}
    got = {r.word: r.n for r in count_words(misspelt(runs(make_docs(rows)))).collect()}
    assert got == want and len(want) > 5
