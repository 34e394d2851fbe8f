"""Byte-level BPE by segment trees.

A pretoken's symbols are the leaves of a segment tree; the leaf of a symbol
holds the merge rank of the pair it starts (with its place, so that the least
value is the leftmost pair of the lowest rank). The root names the next merge;
a merge changes at most three leaves, each a logarithmic point update, until
no pair can merge. Pretokens of equal tree size are merged side by side as
rows of one array; long ones run alone on a tree of their own.

Each map task remembers the ids of recent pretokens in a bounded cache. The
tokenizer file is read once on the driver and its tables (bounded by the
vocabulary) are broadcast. One pass over the table, no shuffle.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aerolap.llm.common import mapped, quoted

# Fixed value: the pre-tokenizing pattern of the byte-level files.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
NONE = np.int64(1) << 62
SIDE_BY_SIDE = 64                        # longest pretoken (bytes) merged in rows
SEGMENT = 1 << 20                        # characters of a very long text encoded at once
_SAFE_CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")
CACHE = 1 << 18                          # pretokens remembered, in each of two generations


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in the files: itself
    for printable Latin-1, the next code point from 256 on for the others."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(other)) for b in range(256)]


class Vocabulary:
    """Tables of a byte-level BPE file (JSON text)."""

    def __init__(self, file_text: str):
        spec = json.loads(file_text)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        chars = byte_alphabet()
        to_byte = {c: b for b, c in enumerate(chars)}
        self.first = np.array([vocab[c] for c in chars], dtype=np.int64)
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *self.added.values()])
        self.bytes_of = [b""] * size
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(to_byte[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        left, right, made = [], [], []
        for m in model["merges"]:
            a, b = m.split(" ") if isinstance(m, str) else m
            left.append(vocab[a]), right.append(vocab[b]), made.append(vocab[a + b])
        self.made = np.array(made, dtype=np.int64)
        self._hash_pairs(np.array(left, dtype=np.uint64), np.array(right, dtype=np.uint64))

    def _hash_pairs(self, left: np.ndarray, right: np.ndarray) -> None:
        """Open-addressing table: pair key -> rank, at most a quarter full."""
        keys = left << np.uint64(32) | right
        self.bits = max(8, int(4 * len(keys)).bit_length())
        slots = 1 << self.bits
        self.keys = np.full(slots, -1, dtype=np.int64)
        self.ranks = np.full(slots, NONE, dtype=np.int64)
        # the first of equal pairs counts
        _, at = np.unique(keys, return_index=True)
        rest = np.sort(at)
        where = self._slot(keys[rest])
        while len(rest):
            free = self.keys[where] < 0
            _, one = np.unique(where, return_index=True)
            ok = np.zeros(len(rest), dtype=bool)
            ok[one] = True
            ok &= free
            self.keys[where[ok]] = keys[rest[ok]].astype(np.int64)
            self.ranks[where[ok]] = rest[ok]
            rest, where = rest[~ok], (where[~ok] + 1) & (slots - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, NONE if it does not merge."""
        keys = (left << 32) | right
        where = self._slot(keys.astype(np.uint64))
        seen = self.keys[where]
        out = np.where(seen == keys, self.ranks[where], NONE)
        open_ = np.flatnonzero((seen != keys) & (seen >= 0))
        where = where[open_]
        while len(open_):
            where = (where + 1) & (len(self.keys) - 1)
            seen = self.keys[where]
            hit = seen == keys[open_]
            out[open_[hit]] = self.ranks[where[hit]]
            go = ~hit & (seen >= 0)
            open_, where = open_[go], where[go]
        return out

    # --- merging --------------------------------------------------------------

    def merge_rows(self, words: list[bytes], leaves: int) -> list[bytes]:
        """Ids (little-endian 32-bit) of pretokens of at most ``leaves`` bytes."""
        n = np.array([len(w) for w in words])
        rows, place = len(words), np.arange(leaves)
        raw = np.zeros((rows, leaves), dtype=np.uint8)
        inside = place < n[:, None]
        raw[inside] = np.frombuffer(b"".join(words), np.uint8)
        symbol = self.first[raw]
        after = np.broadcast_to(place + 1, (rows, leaves)).copy()
        before = np.broadcast_to(place - 1, (rows, leaves)).copy()
        alive = inside.copy()
        bits = leaves.bit_length()

        tree = np.full((rows, 2 * leaves), NONE, dtype=np.int64)
        r, c = np.nonzero(place + 1 < n[:, None])
        tree[r, leaves + c] = self._leaf(self.rank(symbol[r, c], symbol[r, c + 1]), c, bits)
        span = leaves
        while span > 1:
            half = span // 2
            tree[:, half: span] = np.minimum(tree[:, span: 2 * span: 2], tree[:, span + 1: 2 * span: 2])
            span = half

        act = np.flatnonzero(tree[:, 1] < NONE)
        while len(act):
            root = tree[act, 1]
            i = root & ((1 << bits) - 1)
            j = after[act, i]
            k = after[act, j]
            merged = self.made[root >> bits]
            symbol[act, i] = merged
            alive[act, j] = False
            after[act, i] = k
            more = k < n[act]
            before[act[more], k[more]] = i[more]
            tree[act, leaves + j] = NONE
            right = np.full(len(act), NONE)
            right[more] = self._leaf(self.rank(merged[more], symbol[act[more], k[more]]), i[more], bits)
            tree[act, leaves + i] = right
            p = before[act, i]
            has = p >= 0
            tree[act[has], leaves + p[has]] = self._leaf(
                self.rank(symbol[act[has], p[has]], merged[has]), p[has], bits)
            p = np.where(has, p, i)
            a, b, d = (leaves + i) >> 1, (leaves + j) >> 1, (leaves + p) >> 1
            span = leaves
            while span > 1:
                for x in (a, b, d):
                    tree[act, x] = np.minimum(tree[act, 2 * x], tree[act, 2 * x + 1])
                a, b, d, span = a >> 1, b >> 1, d >> 1, span // 2
            act = act[tree[act, 1] < NONE]
        flat = symbol[alive].astype("<u4").tobytes()
        end = np.cumsum(alive.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip([0, *end[:-1].tolist()], end.tolist())]

    @staticmethod
    def _leaf(rank: np.ndarray, place: np.ndarray, bits: int) -> np.ndarray:
        return np.where(rank < NONE, (rank << bits) | place, NONE)

    def merge_long(self, word: bytes) -> bytes:
        """The same for one long pretoken."""
        n = len(word)
        symbol = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        bits = n.bit_length()
        leaves = 1 << (n - 1).bit_length()
        none = int(NONE)
        s = np.array(symbol)
        base = np.full(leaves, NONE)
        base[: n - 1] = self._leaf(self.rank(s[:-1], s[1:]), np.arange(n - 1), bits)
        levels = [base]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        tree = [none, *(x for level in reversed(levels) for x in level.tolist())]
        pair, made, mask = self._pair_ranks(), self._made_list(), (1 << bits) - 1

        def put(place: int, value: int) -> None:
            at = leaves + place
            tree[at] = value
            at >>= 1
            while at:
                a, b = tree[2 * at], tree[2 * at + 1]
                low = a if a < b else b
                if tree[at] == low:
                    break
                tree[at] = low
                at >>= 1

        def leaf(place: int, left: int, right: int) -> int:
            rank = pair.get((left << 32) | right)
            return none if rank is None else (rank << bits) | place

        while tree[1] < none:
            i = tree[1] & mask
            j = after[i]
            k = after[j]
            symbol[i] = merged = made[tree[1] >> bits]
            after[i] = k
            symbol[j] = -1
            put(j, none)
            if k < n:
                before[k] = i
                put(i, leaf(i, merged, symbol[k]))
            else:
                put(i, none)
            p = before[i]
            if p >= 0:
                put(p, leaf(p, symbol[p], merged))
        return np.array([x for x in symbol if x >= 0], dtype="<u4").tobytes()

    def _pair_ranks(self) -> dict[int, int]:
        if not hasattr(self, "_pairs"):
            full = self.keys >= 0
            self._pairs = dict(zip(self.keys[full].tolist(), self.ranks[full].tolist()))
        return self._pairs

    def _made_list(self) -> list[int]:
        if not hasattr(self, "_made"):
            self._made = self.made.tolist()
        return self._made

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("_pairs", "_made")}


class Encoder:
    """Text to ids and back, with a bounded cache of pretokens."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.find = regex.compile(PATTERN).findall
        added = sorted(vocabulary.added, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, added)) + ")").split if added else None

    def _learn(self, words: set[str]) -> None:
        """Make sure ``recent`` holds every word."""
        if len(self.recent) > CACHE:
            self.older, self.recent = self.recent, {}
        recent, older = self.recent, self.older
        by_size: dict[int, list[str]] = {}
        for w in words:
            if w not in recent:
                ids = older.get(w)
                if ids is not None:
                    recent[w] = ids
                else:
                    by_size.setdefault((len(w.encode()) - 1).bit_length(), []).append(w)
        for level, group in by_size.items():
            raw = [w.encode() for w in group]
            if 1 << level > SIDE_BY_SIDE:
                ids = map(self.vocabulary.merge_long, raw)
            else:
                leaves, ids = 1 << level, []
                for at in range(0, len(raw), 1 << 15):
                    ids += self.vocabulary.merge_rows(raw[at: at + (1 << 15)], max(leaves, 2))
            recent.update(zip(group, ids))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        added = self.vocabulary.added
        if len(texts) == 1 and len(texts[0]) > 2 * SEGMENT:
            return [b"".join(x for part in segments(texts[0]) for x in self.encode_all([part]))]
        cut: list[list[list[str] | bytes]] = []
        words: set[str] = set()
        for t in texts:
            parts = []
            if self.split is None or not any(a in t for a in added):
                parts.append(self.find(t))
            else:
                for i, piece in enumerate(self.split(t)):
                    parts.append(added[piece].to_bytes(4, "little") if i % 2 else self.find(piece))
            for p in parts:
                if not isinstance(p, bytes):
                    words.update(p)
            cut.append(parts)
        self._learn(words)
        ids = self.recent.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(ids, p)) for p in parts) for parts in cut]

    def decode(self, ids: bytes) -> str:
        table = self.vocabulary.bytes_of
        raw = b"".join(map(table.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode("utf-8", errors="replace")


def segments(text: str) -> Iterator[str]:
    """A very long text in parts whose pretokens are those of the whole.

    A part ends before a single space between two letters: the pattern always
    starts a pretoken there (added tokens hold no space).
    """
    start = 0
    while len(text) - start > 2 * SEGMENT:
        m = _SAFE_CUT.search(text, start + SEGMENT)
        if m is None:
            break
        yield text[start: m.start()]
        start = m.start()
    yield text[start:]


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[list[str]]:
    """Whole texts (null: empty) in lists of about ``limit`` characters."""
    part, size = [], 0
    for i in range(len(column)):
        t = column[i].as_py() or ""
        if part and size + len(t) > 2 * limit:
            yield part                    # a very long text is a slice of its own
            part, size = [], 0
        part.append(t)
        size += len(t)
        if size >= limit:
            yield part
            part, size = [], 0
    if part:
        yield part


_encoders: dict[str, Encoder] = {}


def _encoder(key: str, shared) -> Encoder:
    """One encoder per worker process and vocabulary: tasks share its cache."""
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(shared.value)
    return _encoders[key]


def _encode(batches: Iterator[pa.RecordBatch], shared, key: str, text_at: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(key, shared)
    for batch in batches:
        done = 0
        for texts in text_slices(batch.column(text_at)):
            ids = encoder.encode_all(texts)
            decoded = [encoder.decode(x) for x in ids]
            part = batch.slice(done, len(texts))
            done += len(texts)
            yield pa.record_batch(
                [*(part.column(i) for i in range(part.num_columns) if i != text_at),
                 pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=[*(n for i, n in enumerate(part.schema.names) if i != text_at), "ids", "decoded"])


def _with_digests(batches: Iterator[pa.RecordBatch], shared, key: str) -> Iterator[pa.RecordBatch]:
    for batch in _encode(batches, shared, key, 1):
        ids = batch.column("ids")
        sha = lambda x: hashlib.sha256(x).hexdigest()
        yield pa.record_batch([
            batch.column(0),
            pa.array([len(x.as_buffer()) // 4 for x in ids], pa.int64()),
            pa.array([sha(x.as_buffer()) for x in ids]),
            pa.array([sha(x.as_buffer()) for x in batch.column("decoded")]),
        ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def load(path: str) -> tuple[Vocabulary, str]:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    return Vocabulary(text), hashlib.sha256(text.encode()).hexdigest()


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Replace ``text`` by ``ids`` (binary, little-endian unsigned 32-bit) and
    ``decoded`` (text again).

    The file's added tokens are cut out of the text first. Null text counts as
    empty: no ids, empty text. Rows are independent, so repeats and null ids
    do not matter; columns ``ids`` and ``decoded`` in ``docs`` are replaced;
    an empty table stays empty.
    """
    vocabulary, key = load(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    source = docs.select(*quoted(c for c in docs.columns if c not in ("ids", "decoded")))
    at = source.columns.index("text")
    schema = T.StructType([*(f for f in source.schema if f.name != "text"), T.StructField("ids", T.BinaryType()),
                           T.StructField("decoded", T.StringType())])
    return mapped(source, lambda it: _encode(it, shared, key, at), schema)


def encode_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``encode`` and the digests of ids and decoded text in the same pass:
    doc_id, n_tokens, ids_sha256, decoded_sha256."""
    vocabulary, key = load(tokenizer_path)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _with_digests(it, shared, key),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
