"""Ingest once: raw / zipped / concise flight files -> Parquet by year and month.

The reference converts files on one machine and its jobs re-parse CSV text
on every run. Here one Spark job parses the input once and writes every row
partitioned by ``rejected``, ``year`` and ``month``: later jobs read only the
columns they use, the flag and a year range prune whole folders
(``leg_candidates(year=...)`` filters the folder column too), and faulty rows
keep their raw line and the names of the columns that could not be read, so a
job can still use a row whose fault is elsewhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.schema import FLIGHT_COLUMNS
from aerolap.sources import csv as C


def parsed_input(spark: SparkSession, path: str | list[str], kind: str = "concise",
                 strict: bool = False) -> DataFrame:
    """Typed flights + ``REPORT_COLUMNS`` from ``kind`` in {concise, raw, zip}."""
    if kind == "concise":
        return C.read_concise(spark, path, strict=strict)
    if kind == "raw":
        fields = C.read_raw(spark, path)
    elif kind == "zip":
        from aerolap.sources.files import read_zipped

        fields = read_zipped(spark, path)
    else:
        raise ValueError("kind must be 'concise', 'raw' or 'zip'")
    typed = C.typed_from_fields(fields)
    return C.strict(typed) if strict else typed


def ingest(spark: SparkSession, path: str, out: str, kind: str = "concise",
           mode: str = "errorifexists", strict: bool = False) -> None:
    """Parse ``path`` once and write all rows by (rejected, year, month).

    The rebalance hint lets AQE merge what many scan tasks hold of one folder
    and split a folder that holds too much, so the number of files follows the
    data and not the number of tasks.
    """
    parsed = (parsed_input(spark, path, kind, strict)
              .withColumn("rejected", F.col("reject_reason").isNotNull().cast("int"))
              .withColumn("year", F.year("flight_date"))
              .withColumn("month", F.month("flight_date")))
    (parsed.select(*FLIGHT_COLUMNS, *C.REPORT_COLUMNS, "rejected", "year", "month")
     .hint("rebalance", "rejected", "year", "month")
     .write.mode(mode).partitionBy("rejected", "year", "month").parquet(out))


def _stored(spark: SparkSession, out: str | list[str]) -> DataFrame:
    paths = [out] if isinstance(out, str) else list(out)
    return spark.read.parquet(*paths)


def read_ingested(spark: SparkSession, out: str | list[str],
                  needs: Sequence[str] | None = None) -> DataFrame:
    """The typed flight frame from an ingested folder (or several).

    Rows without any fault and, if ``needs`` names columns, faulty rows whose
    needed columns were read.
    """
    df = _stored(spark, out)
    good = F.col("rejected") == 0
    if needs is not None:
        good = good | ~F.arrays_overlap("bad_fields", F.array(*map(F.lit, needs)))
    return df.filter(good).select(*FLIGHT_COLUMNS, "year", "month")


def read_rejected(spark: SparkSession, out: str | list[str]) -> DataFrame:
    """Faulty rows with their reason, bad columns and raw line."""
    return _stored(spark, out).filter("rejected = 1").select(*FLIGHT_COLUMNS, *C.REPORT_COLUMNS)
