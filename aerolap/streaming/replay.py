"""SRC-6: replay recorded flight lines into a file stream, in a fixed order.

The reference's producer only listed files; this one writes concise lines
that Spark derived from the tables into the stream's input folder, one part
at a time (``part=<p>`` subfolders), and lets the query consume each part as
its own micro-batch. The order of parts is the order of batches, which makes
per-batch results and the latest-per-key upsert reproducible in tests.

Lines are staged once as Parquet partitioned by part; each feed reads one
partition (partition pruning) and writes it as text with as many files as
its tasks produce.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stage(lines: DataFrame, path: str, part_col: str = "bucket") -> str:
    """Write ``value`` lines partitioned by ``part_col`` (one pass)."""
    lines.select("value", part_col).write.partitionBy(part_col).parquet(path)
    return path


def feed(spark: SparkSession, staged: str, input_dir: str, part,
         part_col: str = "bucket") -> None:
    """Make one part's lines appear under ``input_dir/<part_col>=<part>``."""
    (spark.read.parquet(staged).filter(F.col(part_col).eqNullSafe(F.lit(part)))
     .select("value").write.text(f"{input_dir.rstrip('/')}/{part_col}={part}"))


def parts_of(spark: SparkSession, staged: str, part_col: str = "bucket") -> list:
    """The parts that are staged, in order (a NULL part first): what the names
    of their folders say, without a look at a line."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(staged)
    found = [r[0] for r in files.select(part_col).distinct().collect()]
    return sorted(found, key=lambda p: (p is not None, p))


def run_until_done(query: StreamingQuery, timeout_s: int | None = None) -> None:
    """Wait for an ``available_now`` query, without limit by default."""
    finished = query.awaitTermination(timeout_s)
    if timeout_s is not None and not finished:
        query.stop()
        raise TimeoutError(f"stream {query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")


def replay(spark: SparkSession, staged: str, input_dir: str,
           start: Callable[[], StreamingQuery], parts: Sequence | None = None,
           part_col: str = "bucket", timeout_s: int | None = None) -> None:
    """For each part in order (default: all that are staged): feed it, then run
    the query until caught up.

    ``start`` must build and start an ``available_now`` query over
    ``input_dir`` with a fixed checkpoint, so each run reads only new files.
    """
    for p in parts_of(spark, staged, part_col) if parts is None else parts:
        feed(spark, staged, input_dir, p, part_col)
        run_until_done(start(), timeout_s)
