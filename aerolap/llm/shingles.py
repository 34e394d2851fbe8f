"""Word-shingle sets of whole texts and their min-max signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from aerolap.llm.common import LOWER, U64, Block, blocks, mix, signed, span_hash, text_hash


def shingles(block: Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every shingle, shingles of each row as offsets).

    A-Z count as a-z. A row with fewer words than ``width`` has its whole word
    sequence as one shingle; a row without words has none.
    """
    starts, ends, first = block.words()
    words = text_hash(LOWER[block.data], starts, ends, 0)
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    offsets = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(block.rows), count)
    at = first[row] + np.arange(len(row)) - offsets[row]
    return span_hash(words, at, at + np.minimum(width, n[row]), 2), offsets


def shingle_sets(block: Block, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per row."""
    h, at = shingles(block, width)
    return [np.unique(h[at[i]: at[i + 1]]) for i in range(block.rows)]


def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(7919))
    return (rng.integers(1, 1 << 63, size=n, dtype=np.uint64) * U64(2) + U64(1),
            rng.integers(0, 1 << 63, size=n, dtype=np.uint64))


def min_max(h: np.ndarray, at: np.ndarray, perms: int) -> np.ndarray:
    """Per row with shingles: minimum and maximum under each permutation,
    ``2 * perms`` values from ``perms`` hash evaluations per shingle."""
    full = np.flatnonzero(np.diff(at))
    out = np.empty((len(full), 2 * perms), dtype=np.uint64)
    if len(full):
        for j, (a, b) in enumerate(zip(*permutations(perms))):
            v = h * a + b
            np.minimum.reduceat(v, at[full], out=out[:, 2 * j])
            np.maximum.reduceat(v, at[full], out=out[:, 2 * j + 1])
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature values."""
    bands = values.shape[1] // rows
    grouped = values[:, : bands * rows].reshape(len(values), bands, rows)
    factors = permutations(rows)[0]
    salt = np.arange(1, bands + 1, dtype=np.uint64) * U64(0x9E3779B97F4A7C15)
    return mix((mix(grouped) * factors).sum(axis=2, dtype=np.uint64) + salt)


def signature_rows(batches: Iterator[pa.RecordBatch], width: int, perms: int,
                   rows: int) -> Iterator[pa.RecordBatch]:
    """doc_id, set size, 128-bit digest of the set, band keys."""
    for batch in batches:
        ids = batch.column(0)
        for block in blocks(batch.column(1)):
            h, at = shingles(block, width)
            size, f1, f2 = [], [], []
            for i in range(block.rows):
                u = np.unique(h[at[i]: at[i + 1]])
                d = hashlib.blake2b(u.tobytes(), digest_size=16).digest()
                size.append(len(u))
                f1.append(int.from_bytes(d[:8], "little", signed=True))
                f2.append(int.from_bytes(d[8:], "little", signed=True))
            keys = band_keys(min_max(h, at, perms), rows)
            has = np.diff(at) > 0
            offsets = np.concatenate([[0], np.cumsum(has * keys.shape[1])]).astype(np.int32)
            yield pa.record_batch([
                ids.slice(block.lo, block.rows), pa.array(size, pa.int64()),
                pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), signed(np.ascontiguousarray(keys).reshape(-1))),
            ], names=["doc_id", "n_shingles", "f1", "f2", "bands"])


def set_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """doc_id and its sorted distinct shingle hashes as bytes."""
    for batch in batches:
        for block in blocks(batch.column(1)):
            yield pa.record_batch([
                batch.column(0).slice(block.lo, block.rows),
                pa.array([u.tobytes() for u in shingle_sets(block, width)], pa.binary()),
            ], names=["doc_id", "shingles"])
