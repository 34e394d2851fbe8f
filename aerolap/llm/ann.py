"""Nearest neighbours by largest inner product: query-aware collision counting.

Inner product becomes Euclidean distance by one more component that lifts all
vectors to the largest norm (queries get 0 there). Every vector has one value
per random projection. The table is dealt into blocks of bounded size; a block
keeps, for each projection, its vectors sorted by value. A query opens a
window around its own value in every sorted array and widens all of them step
by step (virtual rehashing: a wider window is a coarser bucket centred on the
query, nothing is hashed again). Each widening counts only the newly covered
entries; vectors whose count passes the threshold are verified with the exact
inner product. A block's search ends after the widening that brings enough
verified vectors, or when the windows cover the block.

Blocks of queries meet blocks of vectors by block id; counts stay inside a
block, only each block's k best per query shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolap.llm.common import spool

BLOCK_ROWS = 8192
QUERY_ROWS = 1024
RATIO = 1.5                              # growth of the radius per widening


def window_width(c: float = RATIO) -> float:
    """Width (at radius 1) that best parts distance 1 from distance c."""
    return math.sqrt(8 * c * c * math.log(c) / (c * c - 1))


def threshold(projections: int, c: float = RATIO) -> int:
    """Collisions between those expected at distance 1 and at distance c."""
    w = window_width(c)
    near, far = (math.erf(w / 2 / r / math.sqrt(2)) for r in (1, c))
    return math.ceil((near + far) / 2 * projections)


def directions(dims: int, projections: int, seed: int = 5) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).standard_normal((dims, projections))


class BlockIndex:
    """The sorted projections of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, top: float, projections: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        lift = np.sqrt(np.maximum(top - (self.vectors ** 2).sum(axis=1), 0))
        self.top = top
        along = directions(vectors.shape[1] + 1, projections)
        values = np.column_stack([self.vectors, lift]) @ along
        # all arrays in one: projection i is shifted by i * span, past the others
        order = np.argsort(values, axis=0, kind="stable").T
        self.order = order.astype(np.intp).reshape(-1)
        low, high = float(values.min()), float(values.max())
        self.span = 4 * (high - low) + 4
        self.shift = np.arange(projections) * self.span - low
        self.low, self.high = low, high
        self.sorted = (np.take_along_axis(values.T, order, axis=1) + self.shift[:, None]).reshape(-1)
        self.along = along[:-1]
        self.first = self._nearest_radius()

    def _nearest_radius(self) -> float:
        """Half the usual distance of a nearest neighbour, from a few rows."""
        some = self._some(32)
        part = self.vectors[some]
        gap = (part ** 2).sum(axis=1)[:, None] + (self.vectors ** 2).sum(axis=1) - 2 * part @ self.vectors.T
        gap[np.arange(len(some)), some] = np.inf
        nearest = np.sqrt(np.maximum(gap.min(axis=1), 0))
        usual = float(np.median(nearest[np.isfinite(nearest)])) if np.isfinite(nearest).any() else 0.0
        return max(usual / 2, 0.02 * math.sqrt(self.top))

    def _some(self, count: int) -> np.ndarray:
        n = len(self.ids)
        return np.linspace(0, n - 1, min(n, count)).astype(np.int64)

    def start_near(self, enough: int) -> None:
        """Let searches open at the radius where a quarter of a few searches
        ended: most then need one or two widenings."""
        ends = [self.search(-1, self.vectors[i], 1, enough)[2] for i in self._some(12)]
        self.first = float(np.quantile(ends, 0.25))

    def _count(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Collisions of every vector with the windows [lo, hi)."""
        n, m = len(self.ids), len(self.shift)
        starts = np.arange(m) * n
        if 2 * int((hi - lo).sum()) <= n * m:
            pieces = [self.order[a:b] for a, b in zip(lo.tolist(), hi.tolist())]
            return np.bincount(np.concatenate(pieces), minlength=n)
        # wide windows: what they leave out is less
        pieces = [self.order[a:b] for a, b in zip(starts.tolist(), lo.tolist())]
        pieces += [self.order[a:b] for a, b in zip(hi.tolist(), (starts + n).tolist())]
        return m - np.bincount(np.concatenate(pieces), minlength=n)

    def search(self, query_id: int, query: np.ndarray, k: int, enough: int) -> tuple[np.ndarray, np.ndarray, float]:
        """(rows, scores) of the k best verified vectors other than the
        query's own, and the radius at the end."""
        n, m = len(self.ids), len(self.shift)
        others = n - int(np.searchsorted(self.ids, query_id, side="right") - np.searchsorted(self.ids, query_id))
        least = threshold(m)
        centre = query @ self.along
        radius, half = self.first, window_width() / 2
        counts, lo, hi = None, None, None
        while True:
            # no further than one past the block's own values
            edge = np.clip([centre - half * radius, centre + half * radius],
                           self.low - 1, self.high + 1) + self.shift
            new_lo = np.searchsorted(self.sorted, edge[0])
            new_hi = np.searchsorted(self.sorted, edge[1], side="right")
            if counts is None:
                counts = self._count(new_lo, new_hi)
            else:
                covered = [self.order[a:b] for a, b in zip(new_lo.tolist(), lo.tolist())]
                covered += [self.order[a:b] for a, b in zip(hi.tolist(), new_hi.tolist())]
                counts += np.bincount(np.concatenate(covered), minlength=n)
            lo, hi = new_lo, new_hi
            rows = np.flatnonzero(counts >= least)
            if len(rows) >= min(enough, others) or (hi - lo == n).all():
                rows = rows[self.ids[rows] != query_id]
                if len(rows) >= min(enough, others) or (hi - lo == n).all():
                    break
            radius *= RATIO
        if len(rows) > k:
            # exact scores for the k best and all that rounding could confuse with them
            rough = self.vectors[rows] @ query
            kth = np.partition(rough, len(rough) - k)[len(rough) - k]
            rows = rows[rough >= kth - 1e-9 * (1 + abs(kth))]
        scores = (self.vectors[rows] * query).sum(axis=1)
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return rows[best], scores[best], radius


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a block as one row: ids and vectors as bytes. Blocks come
    one after the other (sorted within the partition)."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def row(block):
        ids, vectors = (np.concatenate(x) for x in zip(*held.pop(block)))
        return pa.record_batch([pa.array([block], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                                pa.array([vectors.tobytes()], pa.binary())],
                               names=["block", "ids", "vectors"])

    for batch in batches:
        block = batch.column(0).to_numpy()
        ids, vectors = batch.column(1).to_numpy(), _matrix(batch.column(2))
        for b in np.unique(block).tolist():
            for done in [x for x in held if x != b]:
                yield row(done)
            at = block == b
            held.setdefault(b, []).append((ids[at], vectors[at]))
    for done in list(held):
        yield row(done)


def _probe(batches: Iterator[pa.RecordBatch], top: float, projections: int, k: int,
           share: float, least: int) -> Iterator[pa.RecordBatch]:
    last, index, enough = None, None, 0
    for batch in batches:
        for r in batch.to_pylist():
            ids = np.frombuffer(r["ids"], "<i8")
            if last != r["block"]:
                index = BlockIndex(ids, np.frombuffer(r["vectors"], "<f8").reshape(len(ids), -1), top, projections)
                enough = k + max(math.ceil(share * len(ids)), least)
                index.start_near(enough)
                last = r["block"]
            queries = np.frombuffer(r["q_ids"], "<i8")
            points = np.frombuffer(r["q_vectors"], "<f8").reshape(len(queries), -1)
            out = ([], [], [])
            for q, point in zip(queries.tolist(), points):
                rows, scores, _ = index.search(q, point, k, enough)
                for part, x in zip(out, (np.full(len(rows), q), index.ids[rows], scores)):
                    part.append(x)
            yield pa.record_batch([pa.array(np.concatenate(x)) for x in out],
                                  names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 20, projections: int = 64,
            share: float = 0.1, least: int = 200) -> DataFrame:
    """The ``k`` best of ``vectors`` for every row of ``queries``.

    Both have ``vec_id`` and ``embedding`` (array of float or double). Returns
    query_id, rank (from 1), vec_id and score (inner product in double
    precision), best first, ties to the smaller vec_id. A vector with the
    query's own vec_id is no candidate. ``projections`` sorted arrays are kept
    per block; at least ``share`` of a block, and ``least`` vectors, are verified
    per query (recall is measured in the tests).

    Null and zero vectors, those with null or non-finite components, those
    with another length than most, and rows without vec_id take no part.
    Repeated rows are candidates of their own; repeated query rows are one
    query. Fewer than k candidates give
    them all; no candidates or an empty table give no rows. Other columns are
    not read.
    """
    def usable(df):
        return (df.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("v"))
                .where("vec_id IS NOT NULL AND size(v) > 0"
                       " AND forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity'))"
                       " AND exists(v, x -> x <> 0)"))

    mine = usable(vectors)
    facts = (mine.groupBy(F.size("v").alias("dims"))
             .agg(F.count("*").alias("n"),
                  F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("top"))
             .orderBy(F.desc("n"), "dims").limit(1).collect())
    dims, n, top = facts[0] if facts else (0, 0, 0.0)
    blocks = max(1, -(-n // BLOCK_ROWS))
    asked = spool(usable(queries).where(F.size("v") == dims).groupBy("vec_id", "v").agg(F.lit(1)).drop("1"), "asked")
    q_blocks = max(1, -(-asked.count() // QUERY_ROWS))

    def packed(df, count):
        return (df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)))
                .select("block", "vec_id", "v").repartition(count, "block").sortWithinPartitions("block")
                .mapInArrow(_pack, "block bigint, ids binary, vectors binary"))

    table = spool(packed(mine.where(F.size("v") == dims), blocks), "vectors")
    ask = (spool(packed(asked, q_blocks), "queries")
           .select(F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"),
                   F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>")).alias("block")))
    found = (table.join(ask, "block").select("block", "ids", "vectors", "q_ids", "q_vectors")
             .mapInArrow(lambda it: _probe(it, float(top or 0), projections, k, share, least),
                         "query_id bigint, vec_id bigint, score double"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
