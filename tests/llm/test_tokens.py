"""BPE and packing against the tokenizers library and brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerolap.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.load(PATH)[0])


def texts() -> list[str]:
    rng = random.Random(1)
    out = ["", " ", "\n\n  a", "a<|endoftext|> b<|endoftext|>", "<|endoftext|>", "don't you'll I'VE 12 3a",
           "a" * 5000, "ab" * 3000, " " * 999 + "x", "  　\x85\x1c\x1fx", "\U0001f600\U0010ffff"]
    out += [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in [*range(0x300), *range(0x2000, 0x2070), 0x3000, 0xFEFF]]
    out += ["".join(rng.choice("ab cd'sé1#\n\t 漢") for _ in range(rng.randint(1, 300))) for _ in range(300)]
    return out


def test_ids_and_text_equal_the_library(encoder, reference):
    mine = encoder.encode_all(texts())
    for text, ids, want in zip(texts(), mine, reference.encode_batch(texts(), add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
        assert encoder.decode(ids) == reference.decode(want.ids, skip_special_tokens=False) == text


def test_cache_generations_do_not_change_ids(encoder, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 50)
    small = bpe.Encoder(encoder.vocabulary)
    for part in (texts()[i: i + 40] for i in range(0, 400, 40)):
        assert small.encode_all(part) == encoder.encode_all(part)


def test_very_long_texts_in_segments(encoder, reference, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice(["a b", " cd", "'s ", "\n", "  ", "12 ", "é x", "<|endoftext|>"]) for _ in range(3000))
    monkeypatch.setattr(bpe, "SEGMENT", 100)
    assert len(list(bpe.segments(text))) > 20 and "".join(bpe.segments(text)) == text
    ids = np.frombuffer(encoder.encode_all([text])[0], "<u4").tolist()
    assert ids == reference.encode(text, add_special_tokens=False).ids
    assert list(bpe.segments("x" * 1000)) == ["x" * 1000]


def test_incomplete_bytes_decode_like_the_library(encoder, reference):
    ids = [*reference.encode("漢", add_special_tokens=False).ids, 0]
    for cut in ([ids[0]], ids[:-1], ids[1:], ids):
        raw = np.array(cut, dtype="<u4").tobytes()
        assert encoder.decode(raw) == reference.decode(cut, skip_special_tokens=False)


def test_encode_digests(make_docs, awkward, empty, reference):
    got = bpe.encode_digests(awkward, PATH).collect()
    rows = awkward.collect()
    assert len(got) == len(rows)
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, _digest(reference, r["text"] or "")) for r in rows)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0,
                   (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"])) for r in got) == want
    assert bpe.encode_digests(empty, PATH).collect() == []
    full = bpe.encode(awkward, PATH)
    assert set(awkward.columns) - {"text"} < set(full.columns) and full.count() == len(rows)


def _digest(reference, text):
    ids = reference.encode(text, add_special_tokens=False).ids
    raw = np.array(ids, dtype="<u4").tobytes()
    return len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


# --- packing ----------------------------------------------------------------------

def check_packing(rows, docs, reference, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in docs.items():
        ids = np.array([*reference.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        parts = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        at = 0
        for r in parts:
            assert r["start"] == at and 0 < r["length"] <= capacity
            assert r["ids_crc32"] == zlib.crc32(ids[at: at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids) and len(parts) == -(-len(ids) // capacity)
        assert all(r["length"] == capacity for r in parts[1:])
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packing_is_gapless_and_whole(make_docs, reference, capacity):
    rng = random.Random(2)
    docs = {i: " ".join(rng.choice(["the", "of", "xyzzy", "123"]) for _ in range(rng.choice([0, 3, 40, 900, 3000])))
            for i in range(120)}
    docs[500], docs[501] = None, ""
    rows = packing.pack(make_docs(docs.items()), PATH, capacity=capacity).collect()
    n = check_packing(rows, docs, reference, capacity)
    assert n <= 1.05 * sum(r["length"] for r in rows) / capacity + 1


def test_packing_awkward_and_empty(awkward, empty):
    rows = packing.pack(awkward, PATH, keep_ids=True).collect()
    assert sum(r["piece"] == 0 for r in rows) == awkward.count()
    assert all(len(r["ids"]) == 4 * r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] for r in rows)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack(empty, PATH).collect() == []


def optimum(lengths, capacity):
    """Fewest sequences by exhaustive search."""
    lengths, best = sorted(lengths, reverse=True), [len(lengths)]

    def go(i, room):
        if len(room) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(room)
            return
        for k in range(len(room)):
            if room[k] >= lengths[i] and room[k] not in room[:k]:
                go(i + 1, [*room[:k], room[k] - lengths[i], *room[k + 1:]])
        go(i + 1, [*room, capacity - lengths[i]])
    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(40))
def test_reduction_keeps_the_optimum(seed):
    """The fixed sets plus an optimal packing of the rest are optimal."""
    rng = random.Random(seed)
    capacity = rng.choice([10, 20, 30])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
    counts = {x: lengths.count(x) for x in lengths}
    found, fixed = packing.patterns(counts, capacity)
    used = defaultdict(int)
    for times, parts in found:
        assert times > 0 and sum(a * b for a, b in parts) <= capacity
        for a, b in parts:
            used[a] += times * b
    assert used == counts
    rest = [a for times, parts in found[fixed:] for a, b in parts for _ in range(times * b)]
    assert sum(t for t, _ in found[:fixed]) + optimum(rest, capacity) == optimum(lengths, capacity)


def test_large_counts_take_few_patterns():
    rng = random.Random(3)
    counts = {x: rng.randint(1, 10**9) for x in range(1, 1025)}
    found, _ = packing.patterns(counts, 1024)
    assert len(found) < 4000
    assert sum(t for t, _ in found) <= 1.01 * lower_bound(counts, 1024)


def lower_bound(counts, capacity):
    """Sequences that any packing needs: pieces over half a sequence never
    share, and only small ones fit beside them."""
    best = 0
    for small in range(1, capacity // 2 + 1):
        alone = sum(n for x, n in counts.items() if x > capacity - small)
        large = {x: n for x, n in counts.items() if capacity // 2 < x <= capacity - small}
        room = sum((capacity - x) * n for x, n in large.items())
        rest = sum(x * n for x, n in counts.items() if small <= x <= capacity // 2)
        best = max(best, alone + sum(large.values()) + max(0, -(-(rest - room) // capacity)))
    return best
