"""Flight data derived from the driver's test tables.

The reference reads airline on-time files that are not available here. The
test tables are a TPC-H-like star schema, so flights are *derived* from them
by joins: one lineitem = one flight; carrier = part brand, origin = supplier's
nation, destination = customer's nation, delays and departure time from
lineitem columns, with some values blanked to exercise missing data.

``flight_view`` gives the typed flight frame; ``concise_lines`` renders the
same flights as concise CSV text lines (the reference's input format) for the
parsing, file and stream paths. The DuckDB text of both lives in
``aerolap.plans.oracle`` and is kept expression-for-expression equal.

Join shape: lineitem is the probe side of a chain of joins with base tables
(orders, customer, nation, supplier, nation, part), in the fixture's order.
Which join runs as broadcast and which as shuffled sort-merge is left to
Spark's size check (``autoBroadcastJoinThreshold`` against each table's file
size, re-checked by AQE on real shuffle sizes): at test scale every partner
broadcasts and lineitem is read once in one pipeline; at cluster scale
orders, customer, part and supplier grow with the data and become sort-merge
joins on their keys, while nation (25 rows) always broadcasts.

When customer is past the broadcast limit, the partners are joined among
themselves first: orders to customer to nation, supplier to nation. Lineitem
is then shuffled three times (order, supplier and part key) instead of four
and never on a nation key. Spark's static estimate of a join's size is
multiplicative, so a broadcast of such a subtree would rest on a bad number:
those joins carry a ``merge`` hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions.parse import trunc_minutes
from aerolap.schema import CONCISE_FIELDS

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


_HANDLES: dict[tuple, DataFrame] = {}


def _session_key(spark: SparkSession) -> tuple:
    # the application id changes with every new SparkContext, so a handle
    # never outlives the session it was resolved in
    return (spark.sparkContext.applicationId, id(spark))


def read_table(spark: SparkSession, sf_dir: str, name: str,
               refresh: bool = False) -> DataFrame:
    """The table as a DataFrame; the handle (not the data) is reused per session.

    Resolving a Parquet relation lists its files and reads footers on the
    driver; the test tables are read-only, so one resolution per session is
    enough. ``refresh=True`` resolves again (for tables that change).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (*_session_key(spark), path)
    if refresh or key not in _HANDLES:
        _HANDLES[key] = spark.read.parquet(path)
    return _HANDLES[key]


def _joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_tax", "l_shipdate")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    dest_nation = nation.select(F.col("n_nationkey").alias("c_nk"),
                                F.col("n_name").alias("dest"))
    origin_nation = nation.select(F.col("n_nationkey").alias("s_nk"),
                                  F.col("n_name").alias("origin"))
    if _past_broadcast(spark, customer):
        placed = (orders.join(customer.hint("merge"), F.col("o_custkey") == F.col("c_custkey"))
                  .join(dest_nation, F.col("c_nationkey") == F.col("c_nk")))
        based = supplier.join(origin_nation, F.col("s_nationkey") == F.col("s_nk"))
        return (li.join(placed.hint("merge"), li.l_orderkey == F.col("o_orderkey"))
                .join(based.hint("merge"), li.l_suppkey == F.col("s_suppkey"))
                .join(part, li.l_partkey == part.p_partkey))
    # lineitem stays the streamed (probe) side of every join; each partner
    # is a base table, so the size check sees its real file size.
    return (li
            .join(orders, li.l_orderkey == orders.o_orderkey)
            .join(customer, F.col("o_custkey") == customer.c_custkey)
            .join(dest_nation, F.col("c_nationkey") == F.col("c_nk"))
            .join(supplier, li.l_suppkey == supplier.s_suppkey)
            .join(origin_nation, F.col("s_nationkey") == F.col("s_nk"))
            .join(part, li.l_partkey == part.p_partkey))


def _limit(spark: SparkSession) -> int:
    """Bytes that Spark may broadcast; the view's join order depends on it."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def _past_broadcast(spark: SparkSession, df: DataFrame) -> bool:
    """Whether Spark would not broadcast ``df`` (its plan's size estimate)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) > _limit(spark)


# Derived-value expressions, the same text as the DuckDB fixture view.
_DEP_DELAY = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice / 1000.0 END"
_ARR_DELAY = "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END"
# Delay text with two decimals, from whole hundredths of a minute: the
# departure delay is truncated to hundredths, so its text truncates to the
# same whole minute as the exact value. Integer arithmetic only, so every
# engine prints the same digits.
_DEP_HUNDREDTHS = ("CASE WHEN l_linenumber = 7 THEN NULL ELSE "
                   "CAST(round(l_extendedprice * 100) AS BIGINT) div 1000 END")
_ARR_HUNDREDTHS = ("CASE WHEN l_linenumber = 6 THEN NULL ELSE "
                   "CAST(round(l_quantity * 100) AS BIGINT) END")


def _two_decimals(hundredths: str):
    h = F.expr(hundredths)
    return F.concat(F.expr(f"({hundredths}) div 100").cast("string"), F.lit("."),
                    F.lpad((h % 100).cast("string"), 2, "0"))


_DEP_TIME = ("CASE WHEN l_tax = 0.08 THEN NULL ELSE "
             "CAST(((l_partkey * 7 + l_suppkey * 13 + l_orderkey) % 24) * 100 "
             "+ (l_orderkey * 11 + l_linenumber) % 60 AS INT) END")


_VIEWS: dict[tuple, DataFrame] = {}


def _memo(kind: str, spark: SparkSession, sf_dir: str, build) -> DataFrame:
    """One analysed plan per (session, folder): DataFrames are immutable,
    lazy plans, so every query can start from the same one."""
    key = (*_session_key(spark), kind, sf_dir.rstrip("/"))
    if key not in _VIEWS:
        _VIEWS[key] = build()
    return _VIEWS[key]


def flight_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed flights (``schema.FLIGHT_SCHEMA`` columns + ``bucket``)."""
    return _memo(f"flights{_limit(spark)}", spark, sf_dir, lambda: _flight_view(spark, sf_dir))


def _flight_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return _joined(spark, sf_dir).select(
        F.col("p_brand").alias("carrier"),
        F.col("origin"),
        F.col("dest"),
        trunc_minutes(F.expr(_DEP_DELAY), T.DoubleType()).alias("dep_delay_min"),
        trunc_minutes(F.expr(_ARR_DELAY), T.DoubleType()).alias("arr_delay_min"),
        F.expr(_DEP_TIME).alias("dep_time"),
        day.alias("flight_date"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.col("l_suppkey").cast("string").alias("airline_id"),
        (F.col("l_orderkey") % 4).cast("int").alias("bucket"),
    )


def concise_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flights as the eleven concise text fields (+ ``bucket``).

    Delays are printed with two decimals (``68.42``) so truncation is
    exercised (the text truncates to the same minute as ``flight_view``); departure time is zero-padded (``0930``); blanks are NULL,
    which the CSV writer prints as an empty field.
    """
    return _memo(f"concise{_limit(spark)}", spark, sf_dir, lambda: _concise_fields(spark, sf_dir))


def _concise_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate").cast("date")
    return _joined(spark, sf_dir).select(
        F.col("p_brand").alias("carrier"),
        F.col("origin"),
        F.col("dest"),
        _two_decimals(_DEP_HUNDREDTHS).alias("dep_delay_min"),
        _two_decimals(_ARR_HUNDREDTHS).alias("arr_delay_min"),
        F.lpad(F.expr(_DEP_TIME).cast("string"), 4, "0").alias("dep_time"),
        F.year(day).cast("string").alias("year"),
        F.month(day).cast("string").alias("month"),
        F.dayofmonth(day).cast("string").alias("day_of_month"),
        (F.weekday(day) + 1).cast("string").alias("day_of_week"),
        F.col("l_suppkey").cast("string").alias("airline_id"),
        (F.col("l_orderkey") % 4).cast("int").alias("bucket"),
    )


def concise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One concise CSV line per flight: ``value STRING`` (+ ``bucket``)."""
    from aerolap.sources.csv import to_concise_line

    df = concise_fields(spark, sf_dir)
    return df.select(to_concise_line(*CONCISE_FIELDS).alias("value"), "bucket")



def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The concise lines (``value``) with faults that follow from the fields:
    unreadable numbers, impossible days, lines cut after three fields, and
    blank lines. The DuckDB text is ``oracle.FAULTY``."""
    from aerolap.sources.csv import to_concise_line

    df = concise_fields(spark, sf_dir)
    supplier = F.col("airline_id").cast("bigint")
    f = (df.withColumn("arr_delay_min", F.when(supplier % 7 == 1, F.lit("abc")).otherwise(F.col("arr_delay_min")))
         .withColumn("day_of_week", F.when(supplier % 5 == 2, F.lit("x")).otherwise(F.col("day_of_week")))
         .withColumn("month", F.when(supplier % 11 == 3, F.lit("2")).otherwise(F.col("month")))
         .withColumn("day_of_month", F.when(supplier % 11 == 3, F.lit("30")).otherwise(F.col("day_of_month"))))
    line = (F.when(supplier % 13 == 4, to_concise_line("carrier", "origin", "dest"))
            .when(supplier % 17 == 5, F.lit("  "))
            .otherwise(to_concise_line(*CONCISE_FIELDS)))
    return f.select(line.alias("value"))
