"""Near duplicates by min-max hashing, confirmed on full shingle sets.

* Signature. Under each permutation both the minimum and the maximum of a set
  are kept, so a signature of 2p values costs p hash evaluations per shingle.
  Bands of ``rows`` values become keys; the rows per band follow from the
  similarity asked for, so that a pair at the threshold shares no band with a
  probability of at most one in a million.
* Equal sets collapse to one representative first (a 128-bit digest of the
  sorted set), so exact copies cost one row.
* Stars. In each band bucket all members are compared with one head, the
  member with the smallest share of shingles that no other candidate has. Full
  sets are joined to the distinct pairs and compared; links make components.
* The rest. Buckets that still hold several components are finished exactly:
  split into blocks bounded in members and in bytes of sets, all pairs of different components are
  tested inside the tasks that hold two blocks, first by an upper bound from
  set sizes and unshared shingles, then on full sets, and only links that join
  components leave the task. No list of pairs is ever made, and no bucket is
  capped.
* Components by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolap.llm.common import quoted, signed, spool
from aerolap.llm.graph import components
from aerolap.llm.shingles import set_rows, signature_rows

PERMUTATIONS = 96
BLOCK = 512                              # members of a bucket compared in one task,
BLOCK_BYTES = 32 << 20                   # and bytes of their full sets


def rows_per_band(similarity: float, values: int = 2 * PERMUTATIONS, miss: float = 1e-6) -> int:
    """Most rows per band that still find a pair at ``similarity``."""
    fits = [r for r in range(1, values + 1) if (1 - similarity ** r) ** (values // r) <= miss]
    return max(fits, default=1)


def _rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle, its only document in the batch or null)."""
    for batch in batches:
        ids = batch.column(0).to_numpy()
        sets = [np.frombuffer(s.as_buffer(), "<u8") for s in batch.column(1)]
        if not sets:
            continue
        owner = np.repeat(ids, [len(s) for s in sets])
        values, first, n = np.unique(np.concatenate(sets), return_index=True, return_counts=True)
        yield pa.record_batch([signed(values), pa.array(owner[first], mask=n > 1)], names=["shingle", "doc_id"])


def _compare(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Keep the pairs whose full sets are similar enough."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (a, b))
            same = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(den * same >= num * (len(x) + len(y) - same))
        yield pa.record_batch([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))


def _one(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """The rows of all batches as one; byte columns get wide offsets, since
    their sum may pass 2 GiB."""
    schema = pa.schema([f.with_type(pa.large_binary()) if pa.types.is_binary(f.type) else f
                        for f in held[0].schema])
    out = pa.Table.from_batches(held).cast(schema).combine_chunks().to_batches()
    if len(out) != 1:
        raise ValueError(f"a group of {sum(b.num_rows for b in held)} rows does not fit one batch")
    return out[0]


def _blocks(count: Column, size: Column) -> Column:
    """Blocks of a bucket of ``count`` members with ``size`` shingles in all;
    one member a block at the least."""
    return F.greatest(F.ceil(count / BLOCK), F.least(count, F.ceil(8 * size / BLOCK_BYTES))).cast("int")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """The groups of equal first ``keys`` columns of a sorted partition."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(keys)]
        new = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield _one(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield _one(held)


def _possible(g: pa.RecordBatch, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i < j) of a block pair that may still be links: of different
    components, first met in this bucket, in these blocks, and not excluded by
    sizes and unshared shingles."""
    col = lambda name: g.column(name).to_numpy()
    n, unshared, comp, side = col("n"), col("unshared"), col("component"), col("block")
    most = np.minimum((n - unshared)[:, None], (n - unshared)[None, :])
    ok = den * most >= num * (n[:, None] + n[None, :] - most)
    ok &= comp[:, None] != comp[None, :]
    i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
    if i != j:                           # pairs within a block belong to (i, i)
        ok &= side[:, None] != side[None, :]
    a, b = np.nonzero(np.triu(ok, 1))
    band = g.column("band")[0].as_py()
    if len(a) and band:
        keys = g.column("bands").flatten().to_numpy().reshape(g.num_rows, -1)
        first = np.ones(len(a), dtype=bool)
        for at in range(0, len(a), 1 << 16):
            s = slice(at, at + (1 << 16))
            first[s] = ~(keys[a[s], :band] == keys[b[s], :band]).any(axis=1)
        a, b = a[first], b[first]
    return a, b


def _undecided(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Members of a block pair with a possible link."""
    for g in _groups(batches, 3):
        a, b = _possible(g, num, den)
        if len(a):
            yield g.take(pa.array(np.unique(np.concatenate([a, b]))))


def _intersections(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of many pairs of a few sets."""
    if len(a) < 4 * len(sets):
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b)])
    values, at, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = n > 1
    column = np.cumsum(shared) - 1
    row, at = row[shared[at]], column[at[shared[at]]]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    step = 4096
    for lo in range(0, int(shared.sum()), step):
        x, y = np.searchsorted(at, [lo, lo + step])
        part = np.zeros((len(sets), step), dtype=np.float32)
        part[row[x:y], at[x:y] - lo] = 1
        total += part @ part.T
    return total[a, b].astype(np.int64)


def _finish(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Links that join components, found on the full sets of a block pair."""
    for g in _groups(batches, 3):
        a, b = _possible(g, num, den)
        if not len(a):
            continue
        sets = [np.frombuffer(s.as_buffer(), "<u8") for s in g.column("shingles")]
        n = np.array([len(s) for s in sets])
        same = _intersections(sets, a, b)
        linked = den * same >= num * (n[a] + n[b] - same)
        ids, comp = g.column("rep").to_numpy(), g.column("component").to_numpy()
        # one link per pair of components is enough
        seen, out = set(), []
        for x, y in zip(a[linked].tolist(), b[linked].tolist()):
            pair = (min(comp[x], comp[y]), max(comp[x], comp[y]))
            if pair not in seen:
                seen.add(pair)
                out.append((ids[x], ids[y]))
        if out:
            u, v = zip(*out)
            yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def classes(docs: DataFrame, *, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The near-duplicate class of every document.

    Two documents are linked if ``den * |A & B| >= num * |A | B|`` for their
    sets of distinct ``width``-word shingles (A-Z as a-z; a shorter document's
    whole word sequence is its one shingle). Returns doc_id, n_shingles,
    component_id (smallest doc_id reachable over links) and kept (the document
    is that one). Links are confirmed on full sets; components lose a link only
    if no band finds it, at most one in a million at the threshold.

    Null text and texts without words have empty sets and are linked with
    nothing. Rows that share a doc_id are one document: a link of one is a link
    of all that have words; each gives a row. A row without doc_id is linked with
    nothing, its component is null and it is kept. An empty table gives an
    empty table. Other columns are not read.
    """
    num, den = similarity
    text = docs.select("doc_id", "text")
    rows = rows_per_band(num / den)
    info = spool(text.mapInArrow(
        lambda it: signature_rows(it, width, PERMUTATIONS, rows),
        "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, bands array<bigint>"), "signatures")

    some = info.where("n_shingles > 0 AND doc_id IS NOT NULL")
    equal = spool(some.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")),
                  "equal")
    reps = equal.select("rep", "bands")
    keys = reps.select("rep", F.posexplode("bands").alias("band", "key"))
    # stored, like every small side below that a hot key may meet: with plain
    # shuffles on both sides AQE can split the key's rows
    full = spool(keys.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key", "c"), "full")
    shared = spool(keys.join(full, "key"), "buckets")          # rep, band, key, c

    involved = shared.select(F.col("rep").alias("doc_id")).distinct()
    sets = spool(text.join(involved, "doc_id").mapInArrow(
        lambda it: set_rows(it, width), "doc_id bigint, shingles binary"), "sets")
    rare = (sets.mapInArrow(_rare, "shingle bigint, doc_id bigint").groupBy("shingle")
            .agg(F.count("*").alias("c"), F.max("doc_id").alias("doc_id")).where("c = 1 AND doc_id IS NOT NULL")
            .groupBy("doc_id").agg(F.count("*").alias("unshared")))
    sizes = spool(sets.select("doc_id", (F.octet_length("shingles") / 8).cast("bigint").alias("n"))
                  .join(rare, "doc_id", "left")
                  .select(F.col("doc_id").alias("rep"), "n", F.coalesce("unshared", F.lit(0)).alias("unshared")),
                  "sizes")

    # stars
    members = spool(shared.join(sizes, "rep"), "members")
    head = members.groupBy("key").agg(F.min(F.struct(
        (F.col("unshared") / F.col("n")).alias("s"), "rep", "n", "unshared")).alias("h"))
    most = F.least(F.col("n") - F.col("unshared"), F.col("h.n") - F.col("h.unshared"))
    pairs = (members.join(spool(head, "heads"), "key").where(F.col("rep") != F.col("h.rep"))
             .where(den * most >= num * (F.col("n") + F.col("h.n") - most))
             .select(F.greatest("rep", "h.rep").alias("u"), F.least("rep", "h.rep").alias("v")).distinct())
    a = sets.select(F.col("doc_id").alias("u"), F.col("shingles").alias("a"))
    b = sets.select(F.col("doc_id").alias("v"), F.col("shingles").alias("b"))
    links = spool(spool(pairs, "pairs").join(a, "u").join(b, "v").select("u", "v", "a", "b")
                  .mapInArrow(lambda it: _compare(it, num, den), "u bigint, v bigint"), "links")

    # buckets that still hold several components
    found = components(links)
    placed = (members.join(found, F.col("rep") == F.col("node"), "left")
              .select("key", "band", "c", "rep", "n", "unshared", F.coalesce("component", "rep").alias("component")))
    placed = spool(placed, "placed")
    mixed = spool(placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"),
                                                F.sum("n").alias("total"))
                  .where("x < y").select("key", "total"), "mixed")
    blocks = _blocks(F.col("c"), F.col("total"))
    blocked = (placed.join(mixed, "key").join(reps, "rep")
               .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
               .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
               .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                       "band", "rep", "n", "unshared", "component", "block", "bands"))
    schema = blocked.schema
    width_of = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "i", "j"]
    undecided = (blocked.repartition(width_of, *order).sortWithinPartitions(*order)
                 .mapInArrow(lambda it: _undecided(it, num, den), schema))
    finished = (spool(undecided, "undecided").join(sets.withColumnRenamed("doc_id", "rep"), "rep")
                .select(*schema.names, "shingles")
                .repartition(width_of, *order).sortWithinPartitions(*order)
                .mapInArrow(lambda it: _finish(it, num, den), "u bigint, v bigint"))
    more = spool(finished, "links")

    # copies of a set follow their representative
    all_links = links.union(more)
    whole = spool(components(all_links).select("node", "component"), "components")
    of_set = (equal.select("f1", "f2", "rep").join(whole, F.col("rep") == F.col("node"), "left")
              .select("f1", "f2", F.coalesce("component", "rep").alias("component")))
    # of_set has one row per distinct set; most sets have one document
    linked = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    return (info.select("doc_id", "n_shingles", "f1", "f2")
            .join(spool(of_set, "classes"), ["f1", "f2"], "left")
            .withColumn("component_id", F.when(linked, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")))
            .select("doc_id", "n_shingles", "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_one(docs: DataFrame, *, width: int = 5, similarity: tuple[int, int] = (80, 100)) -> DataFrame:
    """The documents of ``docs`` that are the smallest of their class, with all
    their columns; cases as in ``classes``. Rows that share a kept doc_id all
    stay."""
    gone = (classes(docs, width=width, similarity=similarity)
            .where("NOT kept").select("doc_id").distinct())
    return docs.join(spool(gone, "gone"), "doc_id", "left_anti").select(*quoted(docs.columns))

