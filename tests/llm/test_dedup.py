"""Line, substring and near dedup against brute force, and awkward rows."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from aerolap.llm.graph import components
from aerolap.llm.line_dedup import remove_lines
from aerolap.llm.near_dedup import classes, keep_one, rows_per_band
from aerolap.llm.substring_dedup import remove_repeats

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def corpus(seed: int, n: int = 60) -> list[tuple[int, str | None]]:
    """Random texts with shared passages, near copies and repeated lines."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 4)))
    text = lambda k: " ".join(word() for _ in range(k))
    passages = [text(rng.randint(45, 120)) for _ in range(4)]
    lines = [text(8).title() + " line" for _ in range(5)]
    out: list[tuple[int, str | None]] = [(1000, None), (1001, "")]
    for i in range(n):
        parts = [text(rng.randint(0, 70))]
        for _ in range(rng.randint(0, 2)):
            p = rng.choice(passages).split()
            a, b = sorted((rng.randrange(len(p)), rng.randrange(len(p))))
            parts += [rng.choice([" ".join(p), " ".join(p[a:b])]), text(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(["", "  ", "\t"]) + rng.choice(lines))
        out.append((rng.randrange(900) if rng.random() < 0.0 else i * 7 % 997, "\n".join(parts)))
        if rng.random() < 0.4:                    # a copy, often edited
            words = out[-1][1].split(" ")
            for _ in range(rng.randint(0, 6)):
                words[rng.randrange(len(words))] = word()
            out.append((500 + i, " ".join(words)))
    return list({i: (i, t) for i, t in out}.values())


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- lines --------------------------------------------------------------------

def brute_lines(rows, min_points=20, min_docs=3):
    key = lambda line: line.strip("\x20\t\n\x0b\x0c\r").translate(LOWER)
    holders: dict[str, set] = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_points:
                holders.setdefault(key(line), set()).add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_equal_brute_force(make_docs, seed):
    rows = corpus(seed)
    got = by_id(remove_lines(make_docs(rows)))
    want = brute_lines(rows)
    assert sum(w[1] for w in want.values()) > 10
    assert {i: (r["n_lines"], r["n_dropped"], r["text"]) for i, r in got.items()} == want
    assert all(r["lang"] == "en" and r["spans"] == "x" for r in got.values())


def test_lines_awkward_and_empty(awkward, empty):
    out = remove_lines(awkward)
    assert out.count() == awkward.count()
    got = by_id(out)
    assert got[1]["text"] == "" and got[1]["n_lines"] == 1
    assert got[6]["n_dropped"] == 0                 # in two documents only
    assert remove_lines(empty).collect() == []


def test_a_line_in_every_document_keeps_the_largest(make_docs):
    rows = [(i, f"unique {i}\nA line that everybody has here") for i in range(300)]
    got = by_id(remove_lines(make_docs(rows)))
    assert [i for i, r in got.items() if r["n_dropped"] == 0] == [299]


# --- passages -------------------------------------------------------------------

def brute_repeats(rows, window=50):
    words = {i: WORDS.findall(t or "") for i, t in rows}
    first: dict[tuple, int] = {}
    for i in sorted(words):
        for k in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][k: k + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k: k + window])] < i:
                gone.update(range(k, k + window))
        out[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
    return out


@pytest.mark.parametrize("seed,window,k", [(1, 50, 12), (2, 50, 12), (3, 10, 4)])
def test_repeats_equal_brute_force(make_docs, seed, window, k):
    rows = corpus(seed)
    got = by_id(remove_repeats(make_docs(rows), window=window, k=k, one_space=True))
    want = brute_repeats(rows, window)
    assert sum(w[1] for w in want.values()) > 100
    assert {i: (r["n_words"], r["n_removed"], r["text"]) for i, r in got.items()} == want


def test_repeats_keep_white_space(make_docs):
    passage = " ".join(f"p{i}" for i in range(60))
    got = by_id(remove_repeats(make_docs([(1, f"a\n\n b {passage}"), (2, f"c \t d\n{passage} e"), (3, "f\ng")])))
    assert got[1]["text"] == f"a\n\n b {passage}"
    assert got[2]["text"] == "c \t d\ne" and got[2]["n_removed"] == 60
    assert got[3]["text"] == "f\ng"


def test_repeats_awkward_and_empty(awkward, empty):
    out = remove_repeats(awkward)
    assert out.count() == awkward.count()
    got = by_id(out)
    assert got[1]["text"] == "" and got[1]["n_words"] == 0
    assert got[9]["n_removed"] == 0                 # repeats within one document stay
    assert got[11]["n_removed"] == 0                # rows of one doc_id are one document
    assert remove_repeats(empty).collect() == []


# --- near duplicates ---------------------------------------------------------------

def brute_classes(rows, width, num, den):
    sets = {}
    for i, t in rows:
        w = WORDS.findall((t or "").translate(LOWER))
        sets[i] = {tuple(w[k: k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()
    at = {i: i for i in sets}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            same = len(sets[a] & sets[b])
            if same and den * same >= num * (len(sets[a]) + len(sets[b]) - same):
                x, y = root(a), root(b)
                at[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


@pytest.mark.parametrize("seed,width,num", [(1, 3, 85), (2, 5, 80)])
def test_classes_equal_brute_force(make_docs, seed, width, num):
    rows = corpus(seed)
    rows += [(2000 + i, t) for i, t in rows[:15]]            # exact copies
    got = by_id(classes(make_docs(rows), width=width, similarity=(num, 100)))
    want = brute_classes(rows, width, num, 100)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_chain_of_near_copies_is_one_class(make_docs, monkeypatch):
    """Neighbours are similar, the ends are not; blocks smaller than a bucket."""
    from aerolap.llm import near_dedup

    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        for _ in range(3):
            words[rng.randrange(300)] = f"n{rng.random()}"
    got = by_id(classes(make_docs(rows), width=3, similarity=(85, 100)))
    want = brute_classes(rows, 3, 85, 100)
    assert {i: r["component_id"] for i, r in got.items()} == {i: w[1] for i, w in want.items()}
    assert len({w[1] for w in want.values()}) < 10


def test_blocks_are_bounded_by_bytes_too(make_docs, monkeypatch, spark):
    from pyspark.sql import functions as F

    from aerolap.llm import near_dedup

    buckets = spark.createDataFrame([(1, 10), (1000, 10 ** 6), (1000, 270 * 10 ** 6), (3, 10 ** 9)], "c int, n bigint")
    got = [r[0] for r in buckets.select(near_dedup._blocks(F.col("c"), F.col("n"))).collect()]
    assert got == [1, 2, 65, 3]
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(120)] = f"n{rng.random()}"
        rows.append((i, " ".join(w)))
    got = by_id(classes(make_docs(rows), width=3, similarity=(85, 100)))
    want = brute_classes(rows, 3, 85, 100)
    assert {i: r["component_id"] for i, r in got.items()} == {i: w[1] for i, w in want.items()}


def test_a_group_past_2_gib_stays_whole():
    """Sets of 100 MB each, the last two alike: their link is found."""
    import numpy as np
    import pyarrow as pa

    from aerolap.llm.near_dedup import _finish, _groups

    sets = pa.array([bytes(100 << 20)], pa.binary())
    batch = pa.record_batch([pa.array([1]), sets], names=["key", "shingles"])
    assert [g.num_rows for g in _groups([batch] * 22, 1)] == [22]
    # members that sizes rule out hold the bytes
    n = np.r_[np.arange(20, 0, -1) * 10 ** 9, 3, 3]
    small = pa.array([np.arange(3, dtype="<u8").tobytes()], pa.binary())
    rows = [pa.record_batch(
        [pa.array([v]) for v in (5, 0, 0, 0, i, int(n[i]), 0 if i > 19 else int(n[i]), i, 0)] + [small if i > 19 else sets],
        names=["key", "i", "j", "band", "rep", "n", "unshared", "component", "block", "shingles"]) for i in range(22)]
    rows = rows[:20] + [rows[0]] * 2 + rows[20:]
    assert [b.to_pylist() for b in _finish(rows, 80, 100)] == [[{"u": 20, "v": 21}]]


def test_group_around_one_original(make_docs):
    """Copies near the threshold of each other: every link counts."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(120)] = f"n{rng.random()}"
        rows.append((i, " ".join(w)))
    got = by_id(classes(make_docs(rows), width=3, similarity=(85, 100)))
    want = brute_classes(rows, 3, 85, 100)
    assert {i: r["component_id"] for i, r in got.items()} == {i: w[1] for i, w in want.items()}
    assert 1 < len({w[1] for w in want.values()}) < 150


def test_classes_awkward_and_empty(awkward, empty):
    out = classes(awkward, width=3, similarity=(85, 100)).collect()
    assert len(out) == awkward.count()
    got = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert got[1]["n_shingles"] == 0 and got[1]["component_id"] == 1 and got[2]["component_id"] == 2
    assert got[5]["n_shingles"] == 1 and got[11]["component_id"] == 11
    assert [(r["component_id"], r["kept"]) for r in out if r["doc_id"] is None] == [(None, True)] * 2
    assert classes(empty).collect() == []
    kept = keep_one(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert keep_one(empty).collect() == []


def test_rows_per_band_meets_the_bound():
    for s in (0.7, 0.8, 0.85, 0.9):
        r = rows_per_band(s)
        assert (1 - s ** r) ** (192 // r) <= 1e-6 < (1 - s ** (r + 1)) ** (192 // (r + 1))


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(5, 7), (7, 5), (7, 7), (9, 7)] + [(50, i) for i in range(60, 90)]
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got.pop(50, 50) == 50
    assert {i: got[i] for i in range(101, 141)} == {i: 100 for i in range(101, 141)}
    assert {i: got[i] for i in (7, 9)} == {7: 5, 9: 5} and got[60] == 50
    assert components(df.limit(0)).collect() == []


def thue_morse(n: int) -> tuple[str, str]:
    """Two different strings that agree in every polynomial modulo 2^64."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_different_long_words_and_lines_are_not_equal(make_docs):
    from aerolap.llm.quality import judge, train

    a, b = thue_morse(2048)
    out = {r.doc_id: r.n_dropped for r in remove_lines(make_docs([(1, a), (2, a), (3, b)])).collect()}
    assert out == {1: 0, 2: 0, 3: 0}
    out = {r.doc_id: r.component_id for r in classes(make_docs([(1, a), (2, b), (3, f"{a} {a}")]), width=3,
                                                     similarity=(85, 100)).collect()}
    assert out == {1: 1, 2: 2, 3: 3}
    out = {r.doc_id: r.n_removed for r in remove_repeats(make_docs([(1, " ".join([a] * 60)), (2, " ".join([b] * 60))]))
           .collect()}
    assert out == {1: 0, 2: 0}
    docs = make_docs([(1, f"{a}\n{b}"), (2, f"{a}\n{a}")], clash=False)
    labels = docs.select("doc_id").selectExpr("doc_id", "1 AS quality", "0 AS toxic")
    out = {r.doc_id: r.n_dup_lines for r in judge(docs, train(docs, labels)).collect()}
    assert out == {1: 0, 2: 1}


def test_rows_that_share_an_id_are_cut_by_their_own_windows(make_docs):
    p, q = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    out = sorted((r.doc_id, r.n_removed, r.text) for r in remove_repeats(
        make_docs([(1, p), (2, p), (2, q), (3, q), (3, None)])).collect())
    assert out == [(1, 0, p), (2, 0, q), (2, 60, ""), (3, 0, ""), (3, 60, "")]


def test_column_names_with_dots(make_docs):
    docs = make_docs([(1, "some text"), (2, "some text")]).withColumn("meta.src", F.lit("x")).withColumn("a`b", F.lit(1))
    for out in (remove_lines(docs), remove_repeats(docs), keep_one(docs)):
        assert {"meta.src", "a`b"} <= set(out.columns) and out.count() >= 1
