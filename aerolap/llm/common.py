"""Helpers shared by the operators of this subpackage.

Text work runs inside Arrow map tasks on numpy views of the UTF-8 buffers: a
batch is cut into blocks of a few MB of whole documents, words are found with
one byte-class lookup, and every word, word window or line gets 64-bit hashes
from prefix sums, so no per-word Python object is made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.session import scratch_path

# Bytes that end a word: space and \x09-\x0D.
WORD_BREAK = np.zeros(256, dtype=bool)
WORD_BREAK[[0x20, *range(0x09, 0x0E)]] = True

# A-Z to a-z, other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

#: Bytes of text worked on at once (a longer document is a block of its own).
BLOCK_BYTES = 1 << 20

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
_BASES = [int(x) | 1 for x in _rng.integers(1 << 62, 1 << 63, size=4, dtype=np.uint64)]
_BYTE_CODES = [_rng.integers(1, 1 << 63, size=256, dtype=np.uint64) for _ in range(2)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spool(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends there,
    and a lost executor costs no recomputation of what lies before it."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name not used in ``df`` (callers' extra columns may clash)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(names) -> list[str]:
    """Column names as references (a name may hold a dot or a back tick)."""
    return ["`" + n.replace("`", "``") + "`" for n in names]


def mapped(df: DataFrame, fn, schema: T.StructType) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` for columns of any name: they are numbered
    on the way, since Spark reads a dot or a back tick in a name as syntax."""
    names = df.columns
    numbered = T.StructType([T.StructField(f"r{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])

    def run(batches):
        for batch in fn(x.rename_columns(names) for x in batches):
            yield batch.rename_columns(numbered.names)

    return df.toDF(*(f"c{i}" for i in range(len(names)))).mapInArrow(run, numbered).toDF(*schema.names)


def marked_texts(docs: DataFrame, marks: DataFrame, name: str,
                 added: list[str], row: str | None = None) -> tuple[DataFrame, T.StructType, int]:
    """Join ``marks`` (doc_id, ``name``) to the documents, as the last column
    (null where there are none). With ``row``, marks also hold the 64-bit hash
    of their row's text in that column. Returns the join, the schema of the
    documents followed by the ``added`` counts, and the index of ``text``."""
    key, mark, text = fresh(docs, "_key"), fresh(docs, "_marks"), fresh(docs, "_text")
    kept = [c for c in docs.columns if c not in added]
    side = marks.select(F.col("doc_id").alias(key), F.col(name).alias(mark), *([F.col(row).alias(text)] if row else []))
    same = F.col("doc_id") == F.col(key)
    if row:
        same = same & (F.xxhash64("text") == F.col(text))
    joined = docs.select(*quoted(kept)).join(side, same, "left").select(*quoted([*kept, mark]))
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(c, T.LongType()) for c in added)])
    return joined, schema, kept.index("text")


def replaced(batch: pa.RecordBatch, text_at: int, texts: list[bytes], **counts: list[int]) -> pa.RecordBatch:
    """The batch with new texts and counts in place of its last column."""
    columns = [batch.column(i) for i in range(batch.num_columns - 1)]
    columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
    return pa.record_batch([*columns, *(pa.array(c, pa.int64()) for c in counts.values())],
                           names=[*batch.schema.names[:-1], *counts])


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (the public splitmix64 constants)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n (grown on demand, per process)."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        base = _BASES[which]
        inverse = pow(base, -1, 1 << 64)
        have = []
        for b in (base, inverse):
            row = np.full(size, b, dtype=np.uint64)
            row[0] = 1
            have.append(np.cumprod(row, dtype=np.uint64))
        _powers[which] = have = tuple(have)
    return have


def span_hash(codes: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of ``codes[start:end]`` for many spans at once, from prefix sums."""
    up, down = powers(which, len(codes) + 1)
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


#: Longest span of bytes that is hashed by the polynomial of ``span_hash``.
SHORT = 64


def digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """BLAKE2b digests (two 64-bit halves) of many spans of bytes."""
    raw = data.tobytes()
    joined = b"".join(hashlib.blake2b(raw[i:j], digest_size=16).digest() for i, j in zip(start.tolist(), end.tolist()))
    return np.frombuffer(joined, "<u8").reshape(-1, 2)


def text_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    """Hash of many spans of bytes; 0 and 1 give independent hashes.

    A polynomial modulo a power of two takes some different long strings for
    equal, whatever its base (Thue-Morse sequences of 1,024 letters), so spans
    over ``SHORT`` bytes get half of a digest instead.
    """
    out = span_hash(byte_codes(data, which), start, end, which)
    long = np.flatnonzero(end - start > SHORT)
    if len(long):
        out[long] = digests(data, start[long], end[long])[:, which]
    return out


def byte_codes(data: np.ndarray, which: int = 0) -> np.ndarray:
    return _BYTE_CODES[which][data]


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[at[0]: at[-1]], at - at[0]


class Block:
    """Consecutive whole documents of one batch."""

    def __init__(self, lo: int, data: np.ndarray, offsets: np.ndarray):
        self.lo = lo                      # index of the first row in the batch
        self.data = data
        self.offsets = offsets            # per row, into data; starts at 0
        self.rows = len(offsets) - 1

    def bytes_of(self, row: int) -> bytes:
        return self.data[self.offsets[row]: self.offsets[row + 1]].tobytes()

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word starts, word ends, first word of each row plus the total)."""
        n = len(self.data)
        if not n:
            z = np.zeros(0, np.int64)
            return z, z, np.zeros(self.rows + 1, np.int64)
        inside = ~WORD_BREAK[self.data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.empty(n, dtype=bool)
        before[0] = True
        np.logical_not(inside[:-1], out=before[1:])
        starts = np.flatnonzero(inside & (before | edge[:-1]))
        after = np.empty(n, dtype=bool)
        after[-1] = True
        np.logical_not(inside[1:], out=after[:-1])
        ends = np.flatnonzero(inside & (after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def lines(self) -> tuple[np.ndarray, ...]:
        """Per line (cut at \\n): row, start, end, start and end without the
        white space at its ends (equal if the line has no word)."""
        breaks = np.flatnonzero(self.data == 0x0A)
        start = np.sort(np.concatenate([self.offsets[:-1], breaks + 1]), kind="stable")
        end = np.sort(np.concatenate([breaks, self.offsets[1:]]), kind="stable")
        owner = np.searchsorted(self.offsets, breaks, side="right") - 1
        row = np.sort(np.concatenate([np.arange(self.rows), owner]), kind="stable")
        words, word_ends, _ = self.words()
        a = b = start
        if len(words):
            i, j = np.searchsorted(words, start), np.searchsorted(words, end)
            some = j > i
            a = np.where(some, words[np.minimum(i, len(words) - 1)], start)
            b = np.where(some, word_ends[np.maximum(j, 1) - 1], start)
        return row, start, end, a, b


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    data, offsets = text_buffer(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield Block(lo, data[offsets[lo]: offsets[hi]], offsets[lo: hi + 1] - offsets[lo])
        lo = hi


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def packed(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, type=pa.binary())
