"""Exact top-k search by largest inner product with a pivot-distance index.

* Integers. Every component x becomes floor(scale * x); scores are exact
  integer inner products. One more component lifts all vectors to the largest
  norm (queries get 0 there), so the largest inner product is the smallest
  Euclidean distance and the triangle inequality holds.
* Copies. Equal vectors are one entry with its k + 1 smallest ids: no other id
  of that vector can be among the k best of any query. Equal queries are
  searched once.
* Keys. An entry is keyed by its nearest pivot and its distance to it. The
  distances of a pivot are cut into annuli of about equal counts from a
  histogram of at most ``PIVOTS * CELLS`` cells; an annulus with very many
  entries is dealt to several blocks by hash.
* Search, first round. A query visits one block of the annulus that holds it
  and learns its k-th best score there: a radius that no better neighbour can
  lie outside of.
* Second round. By the triangle inequality only annuli whose distances meet
  [d - radius, d + radius] of that pivot can hold better entries. They are
  visited; inside a block the sorted distances are scanned in slices outward
  from the queries, the radius shrinks with every better score, and a slice
  beyond it is skipped. Nothing else is skipped, so the result is exact.

Entries and queries of a block meet by sorting on (block, kind): a task holds
one block and streams its queries. Blocks are bounded in bytes, queries per
block by dealing them to parts; only each block's k + 1 best leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolap.llm.common import spool

PIVOTS = 32
CELLS = 1024                             # histogram cells per pivot
SAMPLE = 4096                            # vectors that pivots are fitted on
BLOCK_BYTES = 8 << 20                    # vectors of one block
PART_QUERIES = 1 << 16                   # queries that one part of a block may see
SLICE = 512                              # sorted entries scanned together
STEP = 1024                              # queries scanned together

_ROWS = "block bigint, kind int, dist double, key binary, v binary, floor_score double, id bigint"
_FOUND = "key binary, entry binary, id bigint, score bigint"


def _integers(batches: Iterator[pa.RecordBatch], scale: int, width: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, v): scaled integers as little-endian doubles, padded with zeros."""
    for batch in batches:
        column = batch.column(1)
        n = np.diff(column.offsets.to_numpy())
        flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False))
        out = np.zeros((len(n), width))
        row = np.repeat(np.arange(len(n)), n)
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = flat
        out += 0.0                       # -0.0 and 0.0 are one number
        yield pa.record_batch([batch.column(0), pa.array([r.tobytes() for r in out], pa.binary())],
                              names=["vec_id", "v"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), width)


def fit_pivots(sample: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Centres of ``sample`` after a few rounds of Lloyd's algorithm."""
    rng = np.random.Generator(np.random.PCG64(31))
    centres = sample[rng.permutation(len(sample))[:count]].copy()
    for _ in range(rounds):
        gap = (centres ** 2).sum(axis=1) - 2 * sample @ centres.T
        nearest = gap.argmin(axis=1)
        for c in range(len(centres)):
            mine = sample[nearest == c]
            if len(mine):
                centres[c] = mine.mean(axis=0)
    return centres


class Index:
    """Pivots and annuli: small, sent to the tasks with their code."""

    def __init__(self, pivots: np.ndarray, top: float, width: int):
        self.pivots, self.top, self.width = pivots, top, width
        self.cell = 2 * np.sqrt(top) / CELLS or 1.0
        self.lo = self.hi = self.pivot_of = self.first_block = self.blocks = self.ring_of = None
        # more than rounding can move a distance computed from squares
        self.slack = 1e-6 * np.sqrt(top) + 1e-9

    def lifted(self, v: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.top - (v ** 2).sum(axis=1), 0))
        return np.column_stack([v, lift])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        square = ((lifted ** 2).sum(axis=1)[:, None] + (self.pivots ** 2).sum(axis=1)
                  - 2 * lifted @ self.pivots.T)
        return np.sqrt(np.maximum(square, 0))

    def cells(self, dist: np.ndarray) -> np.ndarray:
        return np.minimum((dist / self.cell).astype(np.int64), CELLS - 1)

    def cut(self, counts: np.ndarray, rows: int) -> None:
        """Annuli of about ``rows`` entries from the (pivot, cell) counts."""
        ring_of = np.full(counts.shape, -1, dtype=np.int64)
        lo, hi, pivot_of, blocks = [], [], [], []
        for p in range(len(counts)):
            held = 0
            for c in np.flatnonzero(counts[p]).tolist():
                if held == 0 or held + counts[p, c] > rows:
                    lo.append(c * self.cell)
                    hi.append(0.0)
                    pivot_of.append(p)
                    blocks.append(0)
                    held = 0
                held += int(counts[p, c])
                # the last cell also takes what lies beyond it
                hi[-1] = (c + 1) * self.cell if c < CELLS - 1 else np.inf
                blocks[-1] = -(-held // rows)
                ring_of[p, c] = len(lo) - 1
        self.lo, self.hi = np.array(lo), np.array(hi)
        self.pivot_of, self.blocks = np.array(pivot_of, np.int64), np.array(blocks, np.int64)
        self.first_block = np.cumsum(self.blocks) - self.blocks
        self.ring_of = ring_of

    def nearest_possible(self, to_pivots: np.ndarray) -> np.ndarray:
        """Lower bound of the distance from each query to each annulus."""
        d = to_pivots[:, self.pivot_of]
        return np.maximum(np.maximum(self.lo - d, d - self.hi), 0) - self.slack

    def radius(self, norms: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Distance at which a vector has that score (inf if there is none)."""
        with np.errstate(invalid="ignore"):
            return np.sqrt(np.maximum(norms + self.top - 2 * score, 0)) + self.slack


def _keyed(batches: Iterator[pa.RecordBatch], index: Index) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        d = index.distances(index.lifted(_matrix(batch.column(1), index.width)))
        pivot = d.argmin(axis=1)
        dist = d[np.arange(len(d)), pivot]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(pivot.astype(np.int32)), pa.array(dist),
                               pa.array(index.cells(dist).astype(np.int32)), batch.column(2)],
                              names=["key", "v", "pivot", "dist", "cell", "id"])


def _spread(key: bytes, n: int) -> int:
    return int.from_bytes(key[:8], "little") % n


def _entry_rows(batches: Iterator[pa.RecordBatch], index: Index, parts: int) -> Iterator[pa.RecordBatch]:
    """Entries as block rows, once for each part of the queries."""
    for batch in batches:
        ring = index.ring_of[batch.column(2).to_numpy(), batch.column(4).to_numpy()]
        keys = batch.column(0).to_pylist()
        block = index.first_block[ring] + [_spread(k, int(n)) for k, n in zip(keys, index.blocks[ring])]
        n = batch.num_rows
        for part in range(parts):
            yield pa.record_batch([pa.array(block * parts + part), pa.array(np.zeros(n, np.int32)), batch.column(3),
                                   batch.column(0), batch.column(1), pa.array(np.zeros(n)), batch.column(5)],
                                  names=["block", "kind", "dist", "key", "v", "floor_score", "id"])


def _query_rows(batches: Iterator[pa.RecordBatch], index: Index, parts: int, home: bool) -> Iterator[pa.RecordBatch]:
    """Queries as rows of the blocks they visit: the home block, or all others
    within the radius of the score known so far (third column)."""
    zero = np.zeros((1, 1))
    for batch in batches:
        if not batch.num_rows:
            continue
        v = _matrix(batch.column(1), index.width)
        d = index.distances(np.column_stack([v, np.repeat(zero, len(v))]))
        bound = index.nearest_possible(d)
        keys = batch.column(0).to_pylist()
        middle = (index.lo + np.minimum(index.hi, index.lo + 4 * index.cell)) / 2
        best = np.lexsort((np.abs(d[:, index.pivot_of] - middle), bound), axis=1)[:, 0]
        score = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
        if home:
            near = np.zeros(bound.shape, dtype=bool)
            near[np.arange(len(v)), best] = True
        else:
            near = bound <= index.radius((v ** 2).sum(axis=1), score)[:, None]
        at, ring = np.nonzero(near)
        rows, blocks, rings = [], [], []
        for i, r in zip(at.tolist(), ring.tolist()):
            first, n = int(index.first_block[r]), int(index.blocks[r])
            own = _spread(keys[i], n)
            for b in range(n):
                # the second round leaves out the block of the first
                if (b == own) if home else (r != best[i] or b != own):
                    rows.append(i)
                    rings.append(r)
                    blocks.append((first + b) * parts + _spread(keys[i][8:], parts))
        for lo in range(0, len(rows), 4 * STEP):
            part = np.array(rows[lo: lo + 4 * STEP])
            yield pa.record_batch([
                pa.array(np.array(blocks[lo: lo + 4 * STEP], np.int64)), pa.array(np.ones(len(part), np.int32)),
                pa.array(d[part, index.pivot_of[rings[lo: lo + 4 * STEP]]]),
                batch.column(0).take(pa.array(part)), batch.column(1).take(pa.array(part)),
                pa.array(score[part]), pa.array(np.zeros(len(part), np.int64))],
                names=["block", "kind", "dist", "key", "v", "floor_score", "id"])


def scan(v: np.ndarray, ids: np.ndarray, dist: np.ndarray, queries: np.ndarray, to_pivot: np.ndarray,
         floor: np.ndarray, k: int, index: Index, exact: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, entry, score) of every query's ``k`` best entries of a block, ties
    to the smaller id. Entries are sorted by their distance to the pivot; a
    slice is skipped for a query if the triangle inequality puts it beyond the
    radius of the query's k-th best score."""
    n = len(v)
    cuts = np.arange(0, n, SLICE)
    low, high = dist[cuts], dist[np.minimum(cuts + SLICE, n) - 1]
    norms = (queries ** 2).sum(axis=1)
    kth = floor.copy()                   # no entry below it is wanted
    if exact is not np.float64:
        v, queries = v.astype(exact), queries.astype(exact)
    bound = np.maximum(np.maximum(low - to_pivot[:, None], to_pivot[:, None] - high), 0) - index.slack
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, exact))
    for s in np.argsort(bound.sum(axis=0), kind="stable"):
        active = np.flatnonzero(bound[:, s] <= index.radius(norms, kth))
        if not len(active):
            continue
        scores = queries[active] @ v[cuts[s]: cuts[s] + SLICE].T
        q, e = np.nonzero(scores >= kth[active][:, None])
        held = tuple(np.concatenate(x) for x in zip(held, (active[q], e + cuts[s], scores[q, e])))
        order = np.lexsort((ids[held[1]], -held[2], held[0]))
        held = tuple(x[order] for x in held)
        start = np.searchsorted(held[0], np.arange(len(queries)))
        full = np.flatnonzero(np.diff(np.append(start, len(held[0]))) >= k)
        kth[full] = held[2][start[full] + k - 1]
        keep = np.arange(len(held[0])) - start[held[0]] < k
        held = tuple(x[keep] for x in held)
    return held


def _search(batches: Iterator[pa.RecordBatch], k: int, index: Index, exact: type) -> Iterator[pa.RecordBatch]:
    block, parts, joined = None, [], None
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        kinds = batch.column(1).to_numpy()
        new = np.flatnonzero((blocks[1:] != blocks[:-1]) | (kinds[1:] != kinds[:-1])) + 1
        for lo, hi in zip([0, *new.tolist()], [*new.tolist(), len(blocks)]):
            if lo == hi:
                continue
            run = batch.slice(lo, hi - lo)
            if block != blocks[lo]:
                block, parts, joined = blocks[lo], [], None
            if kinds[lo] == 0:
                parts.append((run.column(3).to_pylist(), run.column(2).to_numpy(),
                              _matrix(run.column(4), index.width), run.column(6).to_numpy()))
                continue
            if joined is None:
                joined = ([x for p in parts for x in p[0]],
                          *(np.concatenate([p[i] for p in parts]) for i in (1, 2, 3)))
                parts = [()]             # held once
            for at in range(0, run.num_rows, STEP):
                some = run.slice(at, STEP)
                q, e, score = scan(joined[2], joined[3], joined[1], _matrix(some.column(4), index.width),
                                   some.column(2).to_numpy(), some.column(5).to_numpy(), k, index, exact)
                if len(q):
                    yield pa.record_batch([
                        some.column(3).take(pa.array(q)), pa.array([joined[0][i] for i in e.tolist()], pa.binary()),
                        pa.array(joined[3][e]), pa.array(score.astype(np.int64))],
                        names=["key", "entry", "id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, *, k: int = 5, scale: int = 256) -> DataFrame:
    """The ``k`` best of ``vectors`` for every vec_id of ``queries``, exactly.

    Both have ``vec_id`` and ``embedding`` (array of float or double). Returns
    query_id, rank (from 1), vec_id and score (bigint): the integer inner
    product of floor(scale * x), best first, ties to the smaller vec_id. A
    query's own row is no candidate for it.

    Null vectors, vectors with null or non-finite components and rows without
    vec_id take no part; zero and empty vectors do. Vectors of unequal lengths
    count as padded with zeros. Repeated rows count once. Rows that share a
    vec_id but not the vector are candidates of their own, each with its score;
    as queries they are one: a candidate's score is its best over them, and a
    row is no candidate for itself only. Fewer than k candidates give them all;
    no candidates or an empty table give no rows. Scores that could pass 2^62
    raise a ValueError. Other columns are not read.
    """
    def usable(df):
        return (df.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("v"))
                .where("vec_id IS NOT NULL AND v IS NOT NULL"
                       " AND forall(v, x -> x IS NOT NULL AND abs(x) < double('Infinity'))"))

    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + (F.abs(x) * scale + 1) * (F.abs(x) * scale + 1))
    facts = usable(vectors).agg(F.max(square).alias("top"), F.max(F.size("v")).alias("width"))
    asked = usable(queries).agg(F.max(square).alias("top"), F.max(F.size("v")).alias("width"))
    (top, width), (most, longest) = facts.first(), asked.first()
    top, width = max(float(top or 0), float(most or 0)), max(width or 0, longest or 0, 1)
    if top >= 2.0 ** 62:
        raise ValueError("scores of these vectors may not fit 64-bit integers")
    exact = np.float64 if top < 2.0 ** 52 else np.int64

    def integers(df):
        # partial aggregation before the shuffle: repeated rows meet as one
        return (usable(df).mapInArrow(lambda it: _integers(it, scale, width), "vec_id bigint, v binary")
                .groupBy("vec_id", "v").agg(F.lit(1).alias("one"))
                .select("vec_id", F.unhex(F.sha2("v", 256)).alias("key"), "v"))

    per_vector = Window.partitionBy("key").orderBy("vec_id")
    some_ids = (integers(vectors).withColumn("r", F.row_number().over(per_vector)).where(F.col("r") <= k + 1))
    entries = spool(some_ids.select("vec_id", "key", F.when(F.col("r") == 1, F.col("v")).alias("v")), "entries")
    distinct = entries.where("v IS NOT NULL").select("key", "v", F.col("vec_id").alias("id"))
    wanted = spool(integers(queries).withColumnRenamed("vec_id", "query_id"), "wanted")
    questions = spool(wanted.groupBy("key").agg(F.first("v").alias("v")), "questions")

    sample = distinct.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("v").collect()
    asked_rows = questions.count()
    if not sample or not asked_rows:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    points = np.frombuffer(b"".join(bytes(r.v) for r in sample), "<f8").reshape(len(sample), width)
    index = Index(np.zeros((1, width + 1)), top, width)
    index.pivots = fit_pivots(index.lifted(points), min(PIVOTS, len(points)))

    shape = (len(index.pivots), CELLS)
    placed = spool(distinct.mapInArrow(lambda it: _keyed(it, index),
                                       "key binary, v binary, pivot int, dist double, cell int, id bigint"), "placed")
    counts = np.zeros(shape, dtype=np.int64)
    for r in placed.groupBy("pivot", "cell").count().collect():
        counts[r["pivot"], r["cell"]] = r["count"]
    index.cut(counts, max(256, BLOCK_BYTES // (8 * width)))
    parts = max(1, -(-asked_rows // PART_QUERIES))
    shuffles = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def visit(rows: DataFrame, home: bool) -> DataFrame:
        entry = placed.mapInArrow(lambda it: _entry_rows(it, index, parts), _ROWS)
        query = rows.mapInArrow(lambda it: _query_rows(it, index, parts, home), _ROWS)
        met = entry.union(query).repartition(shuffles, "block").sortWithinPartitions("block", "kind", "dist")
        # one more than k: the query's own vector may be among them
        return spool(met.mapInArrow(lambda it: _search(it, k + 1, index, exact), _FOUND), "found")

    first = visit(questions.withColumn("floor_score", F.lit(float("-inf"))), True)
    best_first = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id", "entry"))
    known = (first.withColumn("r", best_first).where(F.col("r") == k + 1)
             .select("key", F.col("score").cast("double").alias("floor_score")))
    unsure = (questions.join(spool(known, "known"), "key", "left")
              .select("key", "v", F.coalesce("floor_score", F.lit(float("-inf"))).alias("floor_score")))
    found = first.union(visit(spool(unsure, "unsure"), False))
    best = found.withColumn("r", best_first).where(F.col("r") <= k + 1).select("key", "entry", "score")
    # k + 1 ids suffice: one of them may be the query's own
    of_key = spool(best.join(entries.select(F.col("key").alias("entry"), "vec_id"), "entry")
                   .withColumn("r", F.row_number().over(
                       Window.partitionBy("key").orderBy(F.desc("score"), "vec_id", "entry")))
                   .where(F.col("r") <= k + 1).select("key", "entry", "vec_id", "score"), "best")
    return (wanted.select("query_id", "key").join(of_key, "key")
            .where("query_id <> vec_id OR key <> entry")
            .groupBy("query_id", "vec_id", "entry").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(
                Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "entry")))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
