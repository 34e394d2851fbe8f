"""SNK-3: keyed result tables written per micro-batch, read as an upsert.

The reference saves each 10-second batch's ranking rows into a keyed table,
so a key's row is replaced by the latest batch that produced it. Here:

* ``batch_writer`` turns a per-batch builder into a ``foreachBatch`` function
  that writes ``<out>/batch_id=<N>`` and then publishes a version of the table
  (``sources.commits``: ``<out>/_versions/<v>.json``, written whole under a new
  number). A batch that was published is not written again when a restarted
  stream replays it, and one that was not is overwritten, so output is
  exactly-once. A builder that reads its batch more than once gets it stored
  first, so the source and the state operator run once;
* a **version** names the batches and the snapshot that make the table. Readers
  pin one (the newest, or one they took with ``version``) and read the folders
  it names: a batch that is being written or a fold that is under way is never
  seen in part;
* ``latest_per_key`` is the table a reader sees: per key, the row of the
  highest version (``max_by`` over the version column);
* ``fold_batches`` folds the closed batches of a long stream into one snapshot
  folder and publishes that; ``batch_writer(fold_every=n, keys=...)`` calls it
  every n batches;
* folders that no newer version names are **retired** and removed once they
  have been so for ``retain_s`` seconds: how long a reader may use a version
  it has pinned. With ``complete=True`` (every batch holds the whole result)
  the batch before is retired, and the last one so is kept in any case;
* ``newest_batch`` reads the last batch of a ``complete`` stream.

A JDBC or Cassandra writer can replace the folder write; neither jar is in
this container.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.session import scratch_path
from aerolap.sources import commits

#: Seconds for which streams keep folders that a reader may have pinned.
RETAIN_S = 3600.0

def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def version(spark: SparkSession, out_path: str, number: int | None = None) -> dict:
    """The newest published version of a table (or the one of that number):
    ``batches`` (number -> folder), ``snapshot`` (``upto``, ``folder``) and
    ``retired`` (folder -> since when), and its own ``number``."""
    folder = f"{out_path.rstrip('/')}/_versions"
    if number is None:
        number = max(commits.numbers(folder), default=None)
        if number is None:
            return {"number": -1, "batches": {}, "snapshot": None, "retired": {}, "run": None}
    return commits.read(folder, number) | {"number": number}


def _publish(spark: SparkSession, base: str, change: Callable[[dict], dict]) -> dict:
    """Publish what ``change`` makes of the newest version; again if another
    writer was first."""
    while True:
        old = version(spark, base)
        new = change(old)
        if commits.publish(spark, f"{base}/_versions", old["number"] + 1, {k: v for k, v in new.items() if k != "number"}):
            return new | {"number": old["number"] + 1}


def _retire(doc: dict, folders) -> dict:
    return doc["retired"] | {f: time.time() for f in folders}


def remove_retired(spark: SparkSession, out_path: str, retain_s: float = RETAIN_S, keep_last: bool = False) -> None:
    """Remove the folders retired for ``retain_s`` seconds (with ``keep_last``
    not the one retired last), then forget them; older versions go with them."""
    base = out_path.rstrip("/")
    doc = version(spark, base)
    due = sorted(doc["retired"], key=doc["retired"].get)
    due = [f for f in (due[:-1] if keep_last else due) if time.time() - doc["retired"][f] >= retain_s]
    for f in due:
        _remove(spark, f"{base}/{f}")
    if due:
        now = _publish(spark, base, lambda d: d | {"retired": {f: t for f, t in d["retired"].items() if f not in due}})
        for n in commits.numbers(f"{base}/_versions"):
            # versions that name a removed folder cannot be read any more
            if n < now["number"] and set(_named(version(spark, base, n))) & set(due):
                _remove(spark, f"{base}/_versions/{n}.json")


def _named(doc: dict) -> list[str]:
    return [*doc["batches"].values(), *([doc["snapshot"]["folder"]] if doc["snapshot"] else [])]


def batch_writer(out_path: str | None, build: Callable[[DataFrame, int], DataFrame],
                 complete: bool = False, reread: bool = False,
                 show: Callable[[DataFrame, int], None] | None = None,
                 keys: Sequence[str] | None = None, fold_every: int | None = None,
                 retain_s: float | None = None, folders: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``reread``: the builder reads its batch more than once; ``show`` gets
    the rows that were built. With ``keys`` and ``fold_every`` the table is
    folded whenever that many batches lie beside the snapshot. ``retain_s``:
    default none for ``complete`` tables, ``RETAIN_S`` for others. ``folders``:
    columns by whose values a batch's files lie in folders of their own."""
    base = out_path.rstrip("/") if out_path else None
    retain = (0.0 if complete else RETAIN_S) if retain_s is None else retain_s

    def write(batch_df: DataFrame, batch_id: int) -> None:
        spark = batch_df.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        target = f"{base}/batch_id={batch_id}" if base else None
        if base:
            now = version(spark, base)
            known = str(batch_id) in now["batches"] or (now["snapshot"] or {}).get("upto", -1) >= batch_id
            if known and now["run"] == run:
                if show is not None and str(batch_id) in now["batches"]:
                    show(spark.read.parquet(target), batch_id)
                return                       # replayed after it was published
            if known:
                raise ValueError(f"{out_path} holds batch {batch_id} of another query; give this one its own folder")
        work = f"{base or scratch_path(spark, 'stream')}/_work"
        if reread:
            # stored, not cached: a self-join reads a cached micro-batch from
            # the source again on one side
            batch_df.write.mode("overwrite").parquet(f"{work}/in")
            batch_df = spark.read.schema(batch_df.schema).parquet(f"{work}/in")
        rows = build(batch_df, batch_id)
        target = target or f"{work}/out"
        rows.write.mode("overwrite").parquet(target, partitionBy=list(folders) or None)
        if show is not None:
            show(spark.read.schema(rows.schema).parquet(target), batch_id)
        if reread or base is None:
            _remove(spark, work)
        if base is None:
            return

        def add(doc: dict) -> dict:
            old = doc["batches"] if complete else {}
            kept = {} if complete else doc["batches"]
            return doc | {"batches": kept | {str(batch_id): f"batch_id={batch_id}"}, "run": run,
                          **({"schema": rows.schema.jsonValue()} if folders else {}),
                          "retired": _retire(doc, old.values())}

        published = _publish(spark, base, add)
        if keys and fold_every and len(published["batches"]) > fold_every:
            fold_batches(spark, base, keys, retain_s=retain, folders=folders)
        remove_retired(spark, base, retain, keep_last=complete)

    return write


def latest_rows(df: DataFrame, keys: Sequence[str], version_col: str = "batch_id",
                keep_version: bool = False) -> DataFrame:
    """Per key, the row with the greatest ``version_col``."""
    keys = list(keys)
    values = [c for c in df.columns if c not in keys and c != version_col]
    latest = df.groupBy(*keys).agg(
        F.max_by(F.struct(*values, version_col), version_col).alias("_v"))
    cols = [*keys, *[F.col(f"_v.{c}").alias(c) for c in values]]
    if keep_version:
        cols.append(F.col(f"_v.{version_col}").alias(version_col))
    return latest.select(*cols)


def _reader(spark: SparkSession, doc: dict, *more: T.StructField):
    """A reader with the schema that a version notes, if any: a batch without
    rows has no files where files lie in folders by value."""
    noted = doc.get("schema")
    return spark.read.schema(T.StructType([*T.StructType.fromJson(noted).fields, *more])) if noted else spark.read


def read_batches(spark: SparkSession, out_path: str, pinned: dict | None = None) -> DataFrame:
    """The rows of all batches of a version (default: the newest) with their
    ``batch_id``, without those folded into a snapshot."""
    base = out_path.rstrip("/")
    doc = pinned or version(spark, base)
    if not doc["batches"]:
        raise ValueError(f"no batches under {out_path}")
    folders = [f"{base}/{f}" for _, f in sorted(doc["batches"].items(), key=lambda x: int(x[0]))]
    return _reader(spark, doc).option("basePath", base).parquet(*folders)


def _versions(spark: SparkSession, base: str, version_col: str, doc: dict) -> DataFrame:
    """Snapshot rows and the batches after it."""
    parts = [_reader(spark, doc, T.StructField(version_col, T.LongType()))
             .parquet(f"{base}/{doc['snapshot']['folder']}")] if doc["snapshot"] else []
    if doc["batches"]:
        parts.append(read_batches(spark, base, doc).withColumn(version_col, F.col("batch_id").cast("bigint")))
    if not parts:
        raise ValueError(f"no batches under {base}")
    out = parts[0].withColumn(version_col, F.col(version_col).cast("bigint"))
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest_per_key(spark: SparkSession, out_path: str, keys: Sequence[str],
                   version_col: str = "batch_id", pinned: dict | None = None,
                   only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The upserted table of a version (default: the newest): the snapshot, if
    any, and the batches after it. ``only`` leaves out keys before the latest
    row of each is sought."""
    base = out_path.rstrip("/")
    rows = _versions(spark, base, version_col, pinned or version(spark, base))
    return latest_rows(only(rows) if only else rows, keys, version_col)


def fold_batches(spark: SparkSession, out_path: str, keys: Sequence[str],
                 keep: int = 1, version_col: str = "batch_id", retain_s: float = 0.0,
                 folders: Sequence[str] = ()) -> int:
    """Fold all but the ``keep`` newest batches into a new snapshot.

    Returns the last folded batch (-1: nothing to fold). The batches folded
    and the older snapshot are retired, and removed after ``retain_s`` seconds;
    the last batch stays, since a restarted stream may write it again.
    """
    base = out_path.rstrip("/")
    doc = version(spark, base)
    batches = sorted(map(int, doc["batches"]))
    folded = doc["snapshot"]["upto"] if doc["snapshot"] else -1
    upto = batches[-1 - max(1, keep)] if len(batches) > max(1, keep) else -1
    if upto <= folded:
        return folded
    closed = doc | {"batches": {n: f for n, f in doc["batches"].items() if int(n) <= upto}}
    latest = latest_rows(_versions(spark, base, version_col, closed), keys, version_col, keep_version=True)
    folder = f"_snapshot/upto={upto}"
    latest.write.mode("overwrite").parquet(f"{base}/{folder}", partitionBy=list(folders) or None)
    gone = _named(closed)

    def swap(now: dict) -> dict:
        return now | {"batches": {n: f for n, f in now["batches"].items() if int(n) > upto},
                      "snapshot": {"upto": upto, "folder": folder}, "retired": _retire(now, gone)}

    _publish(spark, base, swap)
    remove_retired(spark, base, retain_s)
    return upto


def newest_batch(spark: SparkSession, out_path: str, pinned: dict | None = None) -> DataFrame:
    """The rows of the newest batch of a version (default: the newest): the
    whole result of a stream that writes it complete each time."""
    base = out_path.rstrip("/")
    doc = pinned or version(spark, base)
    if not doc["batches"]:
        raise ValueError(f"no batches under {out_path}")
    return spark.read.parquet(f"{base}/{doc['batches'][max(doc['batches'], key=int)]}")
