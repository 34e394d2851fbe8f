"""The prefix trie against one built in memory."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from aerolap.llm import trie
from aerolap.llm.queries import rebuilt
from aerolap.llm.trie import prefix_trie, thin_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string, place string, digest string, b string, key string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA)


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}\n{role}{text}".encode()).digest()


def conversations(rows):
    """conv_id -> [(role, text)] in order (equal turns by digest)."""
    out = {}
    for c, turn, role, text in rows:
        if c is not None:
            out.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    return {c: [t[3:] for t in sorted(turns)] for c, turns in out.items()}


def spliced(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)

    def below(path):
        found, todo = [], [path]
        while todo:
            found.append(todo.pop())
            todo += children.get(found[-1], [])
        return found

    out = set()
    for path, ids in members.items():
        tree = below(path)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in tree if p)
        ends = ",".join(str(c) for c in sorted(ids) if len(convs[c]) == len(path))
        out.add((min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children.get(path, [])),
                 sum(p not in children for p in tree), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def rows_of(df):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(set(got))
    return set(got)


def random_rows(seed, n, words, longest):
    rng = random.Random(seed)
    return [(c, t, ("user", "assistant")[t % 2], rng.choice(words))
            for c in range(n) for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("block", [1, 4])
@pytest.mark.parametrize("words, longest", [(["a", "éé"], 6), (["a", "", "ccc"], 13)])
def test_random_tries(spark, monkeypatch, block, words, longest):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "CHUNK", 20)
    rows = random_rows(block + longest, 60, words, longest)
    assert rows_of(prefix_trie(thin_turns(table(spark, rows)))) == brute(conversations(rows))


def test_rebuilt_conversations(spark):
    rows = random_rows(5, 80, ["a", "bb"], 12)
    rows = [(c - 20, t, r, x) for c, t, r, x in rows if (c - 20) % 15]           # some bases are absent
    convs = spliced(conversations(rows))
    assert any(not turns for turns in convs.values())
    assert rows_of(prefix_trie(*rebuilt(thin_turns(table(spark, rows))))) == brute(convs)


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, None, "", ""), (None, 0, "user", "x"),
            (3, 0, "user", "long " * 50000), (4, 5, "user", "long " * 50000), (4, 5, "user", "other"), (5, -1, None, "é")]
    want = brute(conversations(rows))
    assert rows_of(prefix_trie(thin_turns(table(spark, rows)))) == want
    nothing = thin_turns(table(spark, []))
    assert prefix_trie(nothing).count() == 0
    idle = spark.createDataFrame([(7,), (3,), (None,)], "conv_id bigint")
    ends = hashlib.sha256(b"3,7").hexdigest()
    assert rows_of(prefix_trie(nothing, idle)) == {(3, 0, None, 2, 0, 1, 0, ends)}


def test_long_and_copied_conversations(spark):
    rows = [(0, t, "user", str(t)) for t in range(3000)]
    rows += [(c, t, "user", str(t)) for c in range(1, 400) for t in range(6)]
    want = {(0, d) for d in range(3001)}
    got = prefix_trie(thin_turns(table(spark, rows))).collect()
    assert {(r.conv_id, r.depth) for r in got} == want
    at = {r.depth: r for r in got}
    ends = ",".join(map(str, range(1, 400))).encode()
    assert at[6].n_convs == 400 and at[7].n_convs == 1 and at[6].ends_sha256 == hashlib.sha256(ends).hexdigest()
    assert at[0].saved_tokens == 399 * 6 and at[0].n_leaves == 1 and at[3000].n_children == 0


def test_one_row_per_distinct_block_is_refined(spark):
    """Turn boundaries are grouped only under diverging blocks."""
    rows = [(c, t, "user", "same" if t < 8 else str(c)) for c in range(20) for t in range(9)]
    out = prefix_trie(thin_turns(table(spark, rows)))
    assert rows_of(out) == brute(conversations(rows))
