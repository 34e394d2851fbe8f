"""SRC-1: zipped raw CSV archives, read in place by Spark tasks.

The reference unzips a tree of archives on one machine (four at a time) and
converts each CSV with a separate script. Here:

* **Plan.** ``binaryFile`` lists the archives (paths only, no bodies). Tasks
  read their central directories and the first record of every member; the
  plan (archive, member, size, header) is stored.
* **Deal.** Members, not archives, are dealt to tasks: one at least as large as
  a task's share gets a task of its own, the largest first, so the longest one
  starts at once; the others are hashed to tasks of about that share.
* **Read.** A task streams the records of its members (record = up to a line
  break outside quotes) with the member's header beside each; the columns are
  then picked by name in the JVM, as for plain raw files. Memory per task is
  one chunk (``chunk_rows`` records). A member is not splittable, so the
  largest member bounds the longest task.
* **Quarantine.** An archive or member that cannot be read ends as one row with
  ``fault``; all others are read. Records before a fault inside a member are
  kept. Errors of the file system itself fail the task, and Spark retries it.

Archives are opened where they live (local path or any ``pyarrow.fs`` URI:
HDFS, S3, GCS). Bytes that are not UTF-8 become U+FFFD and the field is
reported as bad.
"""

from __future__ import annotations

import fnmatch
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.schema import CONCISE_FIELDS
from aerolap.session import local_path, scratch_path
from aerolap.sources.csv import fields_by_header
from aerolap.sources.records import ENDS_OPEN

# URI scheme that Spark prints -> the name pyarrow.fs knows it by.
SCHEMES = {"s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs",
           "viewfs": "viewfs", "abfs": "abfs", "abfss": "abfss", "file": "file"}


def arrow_uri(uri: str) -> str:
    """``uri`` with the scheme pyarrow.fs expects; unknown schemes raise."""
    m = re.match(r"([a-zA-Z][a-zA-Z0-9+.-]+):/", uri)
    if m is None:
        return uri
    scheme = m[1].lower()
    if scheme not in SCHEMES:
        raise ValueError(f"cannot open {uri!r} from a task: no file system for scheme "
                         f"{scheme!r} (known: {', '.join(sorted(SCHEMES))})")
    return SCHEMES[scheme] + uri[len(m[1]):]


def open_binary(uri: str, mode: str = "rb"):
    """Open a local path or a filesystem URI as a binary file object."""
    lp = local_path(uri)
    if lp is not None:
        if "w" in mode:
            os.makedirs(os.path.dirname(lp), exist_ok=True)
        return open(lp, mode)
    import pyarrow.fs as pafs

    fs, p = pafs.FileSystem.from_uri(arrow_uri(uri))
    if "w" in mode:
        return fs.open_output_stream(p)
    return fs.open_input_file(p)


def first_record(fh) -> str | None:
    """The first CSV record of a binary file as one line of CSV, without a byte
    order mark; None for an empty file."""
    import csv
    import io

    text = io.TextIOWrapper(fh, encoding="utf-8-sig", errors="replace", newline="")
    names = next(csv.reader(text), None)
    text.detach()
    if names is None:
        return None
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(names)
    return out.getvalue()


def move(src: str, dst: str) -> None:
    """Rename a file within one file system."""
    a, b = local_path(src), local_path(dst)
    if a is not None and b is not None:
        os.replace(a, b)
        return
    import pyarrow.fs as pafs

    fs, a = pafs.FileSystem.from_uri(arrow_uri(src))
    _, b = pafs.FileSystem.from_uri(arrow_uri(dst))
    fs.move(a, b)


def _members(zf, member_glob: str, exclude_suffix: str | None):
    for info in zf.infolist():
        name = info.filename
        if info.is_dir() or not fnmatch.fnmatch(os.path.basename(name), member_glob):
            continue
        if exclude_suffix and name.endswith(exclude_suffix):
            continue
        yield info


def _damages() -> tuple[type[Exception], ...]:
    """What zipfile raises for contents that cannot be read (damaged, cut off,
    encrypted, packed in an unknown way); not the file system's own errors."""
    import zipfile
    import zlib

    return zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError, UnicodeError


def _fault(what: str, e: Exception) -> str:
    return f"unreadable {what}: {type(e).__name__} {e}"[:500]


def _plan(paths: Iterator[str], member_glob: str, exclude_suffix: str | None) -> Iterator[tuple]:
    """(archive, place, member, size, header, fault) from the directories."""
    import zipfile

    for path in paths:
        with open_binary(path) as fh:
            try:
                zf = zipfile.ZipFile(fh)
                infos = [(zf.infolist().index(i), i) for i in _members(zf, member_glob, exclude_suffix)]
            except _damages() as e:
                yield path, None, None, 0, None, _fault("archive", e)
                continue
            for place, info in infos:
                try:
                    with zf.open(info) as member:
                        header = first_record(member)
                except _damages() as e:
                    yield path, place, info.filename, info.file_size, None, _fault("member", e)
                    continue
                if header is not None:       # an empty member has no rows
                    yield path, place, info.filename, info.file_size, header, None


def _records(text, max_lines: int) -> Iterator[str]:
    """Records of a text file after the first; lines of one that does not end
    within ``max_lines`` are given one by one."""
    open_end = re.compile(ENDS_OPEN)
    held: list[str] = []
    first = True
    for line in text:
        held.append(line.rstrip("\r\n") if line.endswith(("\n", "\r")) else line)
        done = not open_end.search(held[0] if len(held) == 1 else '"' + held[-1])
        if done or len(held) > max_lines:
            for record in ["\n".join(held)] if done else held:
                if first:
                    first = False
                elif record.strip():
                    yield record
            held = []
    yield from (x for x in held if not first and x.strip())


def _lines(rows: Iterator[dict], chunk_rows: int, max_lines: int) -> Iterator[pa.RecordBatch]:
    import io
    import zipfile

    opened, zf, fh = None, None, None
    try:
        for row in rows:
            at = row["archive"], row["member"], row["header"]
            if row["fault"]:
                yield _batch(*at, [None], row["fault"])
                continue
            if opened != row["archive"]:
                if fh is not None:
                    fh.close()
                opened, fh = row["archive"], open_binary(row["archive"])
                zf = zipfile.ZipFile(fh)
            chunk: list[str] = []
            try:
                with zf.open(zf.infolist()[row["place"]]) as member:
                    text = io.TextIOWrapper(member, encoding="utf-8-sig", errors="replace", newline="\n")
                    for record in _records(text, max_lines):
                        chunk.append(record)
                        if len(chunk) >= chunk_rows:
                            yield _batch(*at, chunk)
                            chunk = []
            except _damages() as e:
                if chunk:
                    yield _batch(*at, chunk)
                    chunk = []
                yield _batch(*at, [None], _fault("member", e))
            if chunk:
                yield _batch(*at, chunk)
    finally:
        if fh is not None:
            fh.close()


def _batch(archive, member, header, values, fault=None):
    n = len(values)
    text = lambda x: pa.array([x] * n, pa.string())
    return pa.record_batch([text(archive), text(member), text(header), pa.array(values, pa.string()), text(fault)],
                           names=["archive", "member", "header", "value", "fault"])


def _empty_files(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Files without a byte, which Spark's listing leaves out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out = []
    for found in fs.globStatus(root) or []:
        files = fs.listFiles(found.getPath(), True)
        while files.hasNext():
            f = files.next()
            if f.getLen() == 0 and f.getPath().getName().endswith(suffix):
                out.append(f.getPath().toString())
    return out


def plan_members(spark: SparkSession, path: str, member_glob: str = "*.csv",
                 exclude_suffix: str | None = ".concise.csv") -> DataFrame:
    """One row per member of the ``*.zip`` archives below ``path`` and per
    archive that cannot be opened: archive, place, member, size, header,
    fault. Stored: archives are opened once to plan, once to read."""
    archives = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*.zip").load(path).select("path"))
    schema = "archive string, place int, member string, size bigint, header string, fault string"

    def run(batches):
        for batch in batches:
            rows = list(_plan(batch.column(0).to_pylist(), member_glob, exclude_suffix))
            columns = list(zip(*rows)) or [()] * 6
            kinds = (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)],
                                  names=["archive", "place", "member", "size", "header", "fault"])

    stored = scratch_path(spark, "zip-plan")
    empty = spark.createDataFrame([(p,) for p in _empty_files(spark, path, ".zip")], "path string")
    archives.union(empty).mapInArrow(run, schema).write.parquet(stored)
    return spark.read.schema(schema).parquet(stored)


def deal_members(plan: DataFrame, share: int | None = None) -> DataFrame:
    """The plan's rows in the tasks that are to read them.

    A task's share is ``share`` bytes (default: a fourth of what each core
    would get, 32 MB at least). At most total / share members are as large;
    their sizes are known to the driver, the others are dealt by hash."""
    spark = plan.sparkSession
    total = plan.agg(F.sum("size")).first()[0] or 0
    share = share or max(32 << 20, -(-total // (4 * spark.sparkContext.defaultParallelism)))
    large = (plan.where(F.col("size") >= share).orderBy(F.desc("size"), "archive", "place")
             .select("archive", "place").collect())
    rest = plan.where(F.col("size") < share).agg(F.sum("size")).first()[0] or 0
    tasks = max(1, -(-rest // share))
    of_its_own = spark.createDataFrame([(r["archive"], r["place"], n) for n, r in enumerate(large)],
                                       "archive string, place int, own int")
    task = F.coalesce("own", F.lit(len(large)) + F.pmod(F.xxhash64("archive", "place"), F.lit(tasks))).cast("int")
    return (plan.join(of_its_own, ["archive", "place"], "left").withColumn("task", task)
            .repartitionById(len(large) + tasks, "task").sortWithinPartitions("archive", "place")
            .select("archive", "place", "member", "header", "fault"))


def read_zipped(spark: SparkSession, path: str, member_glob: str = "*.csv",
                exclude_suffix: str | None = ".concise.csv",
                chunk_rows: int = 20_000, max_lines: int = 10_000) -> DataFrame:
    """SRC-1 + SRC-2 + FLT-7: raw CSV inside ``*.zip`` archives -> text fields.

    Output: ``archive, member, fault``, the eleven concise text fields,
    ``missing_fields`` and ``raw_line``; feed it to ``csv.typed_from_fields``
    for typed flights (a row with a fault is a rejected one). ``quarantined``
    lists the faults. The driver receives the distinct headers.
    """
    plan = plan_members(spark, path, member_glob, exclude_suffix)
    headers = [r.header for r in plan.where("header IS NOT NULL").select("header").distinct().collect()]

    def run(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        yield from _lines(rows, chunk_rows, max_lines)

    schema = "archive string, member string, header string, value string, fault string"
    fields = fields_by_header(deal_members(plan).mapInArrow(run, schema), headers, keep=("archive", "member", "fault"))
    return fields.withColumns({
        "missing_fields": F.when(F.col("fault").isNotNull(), F.array(*map(F.lit, CONCISE_FIELDS)))
        .otherwise(F.col("missing_fields")),
        "raw_line": F.coalesce("raw_line", F.concat("fault", F.lit(" in "), F.concat_ws(" of ", "member", "archive")))})


def quarantined(rows: DataFrame) -> DataFrame:
    """(archive, member, fault): the archives (member null) and members of
    ``read_zipped`` rows that could not be read to their end."""
    return rows.where("fault IS NOT NULL").select("archive", "member", "fault")
