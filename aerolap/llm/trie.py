"""Prefix trie of conversations by fixed-length block hashing.

* Blocks. A conversation's turns are cut into blocks of ``BLOCK`` turns. Each
  block's key is the digest of its parent key (the block before) and its turns'
  digests, so equal keys mean equal conversations up to there. Conversations
  are grouped block by block: one row per distinct block leaves the grouping,
  however many conversations share it.
* Refinement. If all conversations that go on after a block share the next
  one, the turns inside it are a chain and are read off the block. Only where
  siblings diverge are the turn boundaries inside the blocks grouped again, by
  the digests of their turns, and then per distinct block, not per member.
* Sums over subtrees. A node is named by its smallest member and its depth, so
  each conversation owns one run of depths down to its end. A subtree's sum is
  the owner's run from the node on, and the totals of all owners that branch
  off below it; these reach their ancestors block by block in the same way.

Only (conversation, place, digest, size) rows and keys shuffle; texts are read
once. A conversation of any length is streamed in order, never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolap.llm.common import spool

BLOCK = 4                                # turns of a block
CHUNK = 1 << 18                          # bytes of a piece of a list of ids

ROOT = hashlib.sha256(b"root").digest()
_CHAIN = "conv_id bigint, b bigint, parent binary, key binary, last boolean"
_PIECES = "key binary, first bigint, piece binary"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _sha(x: Column) -> Column:
    return F.unhex(F.sha2(x, 256))


def thin_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, place, digest, size, turns): one row per turn, numbered from 1
    in the order of ``turn`` (null first; equal turns by the digest of role and
    text). Null role or text counts as empty; rows without conv_id are left
    out. ``size`` is the text's UTF-8 bytes, ``turns`` the conversation's
    number of turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    thin = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn",
        _sha(F.concat(F.octet_length(role).cast("string"), F.lit("\n"), role, text)).alias("digest"),
        F.octet_length(text).cast("bigint").alias("size"))
    one = Window.partitionBy("conv_id")
    return thin.select("conv_id", F.row_number().over(one.orderBy(F.asc_nulls_first("turn"), "digest"))
                       .cast("bigint").alias("place"), "digest", "size",
                       F.count("*").over(one).alias("turns"))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of the blocks of each conversation, which come in order."""
    at, key = None, ROOT
    for batch in batches:
        conv, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        parents, keys = [], []
        for c, turns in zip(conv, digests):
            if c != at:
                at, key = c, ROOT
            parents.append(key)
            key = hashlib.sha256(key + b"".join(turns)).digest()
            keys.append(key)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(parents, pa.binary()),
                               pa.array(keys, pa.binary()), batch.column(3)],
                              names=["conv_id", "b", "parent", "key", "last"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of a key in pieces; (key, conv_id) come sorted."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [])
        last, held = None, 0
        for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key != last or held > CHUNK:
                for column, x in zip(out, (key, conv, [])):
                    column.append(x)
                last, held = key, 0
            text = b"%d" % conv
            out[2][-1].append(text)
            held += len(text) + 1
        yield pa.record_batch([pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()),
                               pa.array([b",".join(x) for x in out[2]], pa.binary())],
                              names=["key", "first", "piece"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per key over its pieces, which come in order."""
    last, sha = None, None

    def row(key, sha):
        return pa.record_batch([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], names=["key", "ends_sha256"])

    for batch in batches:
        for key, piece in zip(batch.column(0).to_pylist(), batch.column(2)):
            if key != last:
                if sha is not None:
                    yield row(last, sha)
                last, sha = key, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(memoryview(piece.as_buffer()))
    if sha is not None:
        yield row(last, sha)


def _list_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's conv_ids, ascending, joined by
    commas. Ids are turned into pieces of text in parallel (a key with very
    many ids lies in many partitions); only the pieces of a key meet in one
    task, which streams them."""
    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = spool(ends.repartitionByRange(width, "key", "conv_id").sortWithinPartitions("key", "conv_id")
                   .mapInArrow(_pieces, _PIECES), "pieces")
    return (pieces.repartition(width, "key").sortWithinPartitions("key", "first")
            .mapInArrow(_digests, "key binary, ends_sha256 string"))


def _inner(upto: Column, parent: str = "parent") -> Column:
    """Keys after each of the first ``upto`` turns of a block."""
    key = lambda i: _sha(F.aggregate(
        F.slice("digests", F.lit(1), i), F.col(parent), lambda a, x: F.concat(a, x)))
    return F.when(upto > 0, F.transform(F.sequence(F.lit(1), upto), lambda i: key(i))).otherwise(
        F.array().cast("array<binary>"))


def prefix_trie(thin: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """The nodes of the prefix trie of conversations.

    ``thin`` has conv_id, place (1, 2, ... without gaps), digest, size and turns
    (as ``thin_turns`` gives them); ``convs`` (conv_id) adds conversations
    without turns. A node is a distinct sequence of first turns, from the empty
    root; a conversation that starts with it is a member. Returns per node
    conv_id (smallest member), depth, parent_conv_id (the parent's, null for
    the root), n_convs (members), n_children, n_leaves (childless nodes of its
    subtree), saved_tokens (sum over its subtree of (members - 1) times the
    size of the last turn) and ends_sha256 (of the decimal ids of the members
    that end there, ascending, joined by commas).

    Repeated conversations share all their nodes. No conversation at all gives
    no rows, not even a root.
    """
    if convs is not None:
        idle = convs.select(F.col("conv_id").cast("bigint").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
        idle = spool(idle.join(thin.select("conv_id").distinct(), "conv_id", "left_anti"), "idle")
    width = int(thin.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    # blocks of each conversation and their keys
    b = F.floor((F.col("place") - 1) / BLOCK)
    blocks = spool(
        thin.groupBy("conv_id", b.alias("b"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "size"))).alias("t"), F.max("turns").alias("turns"))
        .select("conv_id", "b", F.col("t.digest").alias("digests"), F.col("t.size").alias("sizes"),
                ((F.col("b") + 1) * BLOCK >= F.col("turns")).alias("last")), "blocks")
    keys = (blocks.select("conv_id", "b", "digests", "last").repartition(width, "conv_id")
            .sortWithinPartitions("conv_id", "b").mapInArrow(_chain, _CHAIN))
    chain = spool(keys, "chain")

    # one row per distinct block; a block's content follows from its key
    shared = (chain.groupBy("key").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"),
                                       F.first("parent").alias("parent"), F.first("b").alias("b")))
    groups = spool(shared.join(blocks.select(F.col("conv_id").alias("least"), "b", "digests", "sizes"),
                               ["least", "b"]), "groups")
    forks = spool(groups.groupBy("parent").agg(F.count("*").alias("c")).where("c > 1").select("parent"), "forks")

    def turns_of(groups: DataFrame, *more) -> DataFrame:
        size = F.size("digests")
        named = groups.withColumn("inner", _inner(size))
        return named.select(
            *more, "least", "n", "parent", "inner", F.posexplode(F.arrays_zip("inner", "sizes")).alias("i", "t")
        ).select(*more, "least", "n", F.col("t.inner").alias("key"), F.col("t.sizes").alias("size"),
                 F.when(F.col("i") == 0, F.col("parent")).otherwise(F.element_at("inner", F.greatest("i", F.lit(1))))
                 .alias("up"), (F.col("i") + 1).cast("bigint").alias("i"))

    depth = (F.col("b") * BLOCK + F.col("i")).alias("depth")
    straight = (turns_of(groups.join(forks, "parent", "left_anti"), "b")
                .select("key", "up", depth, F.col("least").alias("conv_id"), "n", "size"))
    split = (turns_of(groups.join(forks, "parent", "left_semi"), "b").withColumn("depth", depth)
             .groupBy("key").agg(F.first("up").alias("up"), F.first("depth").alias("depth"),
                                 F.min("least").alias("conv_id"), F.sum("n").alias("n"), F.first("size").alias("size")))
    everyone = chain.where("b = 0").select("conv_id")
    if convs is not None:
        everyone = everyone.union(idle)
    top = (everyone.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n > 0")
           .select(F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("up"), F.lit(0).cast("bigint").alias("depth"),
                   "conv_id", "n", F.lit(0).cast("bigint").alias("size")))
    nodes = straight.unionByName(split).unionByName(top)

    # every owner's run of nodes, from its end upwards
    run = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    saved = F.sum((F.col("n") - 1) * F.col("size")).over(run.rowsBetween(Window.unboundedPreceding, 0))
    nodes = spool(nodes.select("*", saved.alias("own"), F.lead("depth").over(run).isNull().alias("first"),
                               F.lag("depth").over(run).isNull().alias("deepest")), "nodes")
    hooked = spool(nodes.where("first AND up IS NOT NULL").groupBy(F.col("up").alias("key"))
                   .agg(F.count("*").alias("hooked")), "hooked")
    nodes = spool(nodes.join(hooked, "key", "left").select(
        *nodes.columns, (F.coalesce("hooked", F.lit(0)) + F.when(F.col("deepest"), 0).otherwise(1))
        .cast("bigint").alias("n_children")), "counted")
    owners = spool(nodes.groupBy("conv_id").agg(
        F.min("depth").alias("from"), F.max("own").alias("total"),
        F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).cast("bigint").alias("leaf")), "owners")

    # what hangs below a node: the totals of all owners that branch off under it
    lower = owners.where("from > 0")
    above = (chain.join(lower, "conv_id").where(F.col("b") * BLOCK < F.col("from") - 1)
             .select("key", F.least(F.col("from") - 1 - F.col("b") * BLOCK, F.lit(BLOCK)).cast("int").alias("cut"),
                     "total", "leaf")
             .groupBy("key", "cut").agg(F.sum("total").alias("total"), F.sum("leaf").alias("leaf")))
    hung = (above.join(groups.select("key", "parent", "digests"), "key")
            .select(F.explode(_inner(F.least("cut", F.size("digests")))).alias("key"), "total", "leaf")
            .union(lower.select(F.lit(ROOT), "total", "leaf"))
            .groupBy("key").agg(F.sum("total").alias("hung"), F.sum("leaf").alias("hung_leaves")))
    ends = chain.where("last").select("key", "conv_id")
    if convs is not None:
        ends = ends.union(idle.select(F.lit(ROOT), "conv_id"))
    parents = nodes.select(F.col("key").alias("up"), F.col("conv_id").alias("parent"))
    moved = nodes.where("first").join(parents, "up", "left").select("key", "parent")

    zero = F.lit(0)
    return (nodes.join(spool(hung, "hung"), "key", "left").join(spool(_list_digests(ends), "ends"), "key", "left")
            .join(spool(moved, "moved"), "key", "left").join(owners.select("conv_id", "leaf"), "conv_id")
            .select("conv_id", "depth",
                    F.when(F.col("first"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
                    F.col("n").alias("n_convs"), "n_children",
                    (F.col("leaf") + F.coalesce("hung_leaves", zero)).alias("n_leaves"),
                    (F.col("own") + F.coalesce("hung", zero)).alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))
