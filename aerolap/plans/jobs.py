"""The reference's named jobs (Q1..Q6) and the spec-only questions (EX-1..5),
each a composition of the operators over a typed flight frame.

Every function is lazy: flights in, DataFrame out, no action.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolap.operators.aggregate import count_by, sum_by
from aerolap.operators.clean import require, zero_fill
from aerolap.operators.itinerary import (
    best_itineraries, itinerary_lists, itinerary_pair_summary, leg_candidates)
from aerolap.operators.reshape import unpivot_endpoints
from aerolap.operators.topk import top_k


def top_airports(flights: DataFrame, k: int = 10, ties: str = "rows") -> DataFrame:
    """Q1: airports by number of flights to or from them, descending.

    Like the reference, nothing is filtered: a missing code is counted too.
    """
    counts = count_by(unpivot_endpoints(flights), ["airport"], "flights")
    return top_k(counts, k, by="flights", item=["airport"], ascending=False, ties=ties)


def measure_name(delay_col: str, metric: str = "sum") -> str:
    """``total_arr_delay``, ``mean_dep_delay``, ..."""
    return f"{'total' if metric == 'sum' else metric}_{delay_col.removesuffix('_min')}"


# Columns a job reads: a fault in any other column costs it no row.
NEEDS = {
    "top-airports": ["origin", "dest"],
    "top-airlines": ["airline_id"],
    "carriers-per-airport": ["origin", "carrier"],
    "dests-per-airport": ["origin", "dest"],
    "carriers-per-route": ["origin", "dest", "carrier"],
    "itineraries": ["origin", "dest", "dep_time", "flight_date"],
}
DELAY = {"top-airports": [], "top-airlines": ["arr_delay_min"], "itineraries": ["arr_delay_min"]}


def needs(job: str, delay_col: str | None = None) -> list[str]:
    """Columns that ``job`` reads with the given (or its own) delay column."""
    return [*NEEDS[job], *([delay_col] if delay_col else DELAY.get(job, ["dep_delay_min"]))]


def _measure(f: DataFrame, keys: list[str], delay_col: str, out: str,
             metric: str) -> DataFrame:
    if metric == "sum":
        return sum_by(f, keys, delay_col, out)
    if metric == "mean":
        return f.groupBy(*keys).agg(F.avg(delay_col).alias(out))
    raise ValueError("metric must be 'sum' or 'mean'")


def top_airlines(flights: DataFrame, k: int = 10, delay_col: str = "arr_delay_min",
                 ties: str = "rows", metric: str = "sum") -> DataFrame:
    """Q2: airlines by total arrival delay, ascending.

    D3: the original measure is the *sum* of delay minutes (few flights win);
    ``metric="mean"`` ranks by mean delay instead. The measure's column is
    named after both (``measure_name``).
    """
    f = require(flights, ["airline_id", delay_col])
    out = measure_name(delay_col, metric)
    totals = _measure(f, ["airline_id"], delay_col, out, metric)
    return top_k(totals, k, by=out, item=["airline_id"], ties=ties)


def top_per_group(flights: DataFrame, group: Sequence[str], item: Sequence[str],
                  k: int = 10, delay_col: str = "dep_delay_min",
                  out: str | None = None, ties: str = "rows",
                  missing: str = "drop", metric: str = "sum") -> DataFrame:
    """AGG-3 + TOP-2/3: per group, the k items with least total delay.

    ``missing="drop"`` is the batch rule (drop rows lacking any field);
    ``missing="zero"`` is the streaming rule (a missing delay counts 0).
    ``metric="mean"`` ranks by mean instead of total delay (D3 extension).
    """
    group, item = list(group), list(item)
    out = out or measure_name(delay_col, metric)
    if missing == "zero":
        f = zero_fill(flights.select(*group, *item, delay_col), [delay_col])
    elif missing == "drop":
        f = require(flights, group + item + [delay_col])
    else:
        raise ValueError("missing must be 'drop' or 'zero'")
    totals = _measure(f, group + item, delay_col, out, metric)
    return top_k(totals, k, by=out, group=group, item=item, ties=ties)


def top_carriers_per_airport(flights: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Q3."""
    return top_per_group(flights, ["origin"], ["carrier"], k, **kw)


def top_dests_per_airport(flights: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Q4."""
    return top_per_group(flights, ["origin"], ["dest"], k, **kw)


def top_carriers_per_route(flights: DataFrame, k: int = 10, **kw) -> DataFrame:
    """Q5 (and EX-3 with ``delay_col="arr_delay_min"``)."""
    return top_per_group(flights, ["origin", "dest"], ["carrier"], k, **kw)


def itinerary_best(flights: DataFrame, year: int | None = None, **kw) -> DataFrame:
    """Q6 as specified / JN-3 / EX-5: best pair per trip and start day."""
    return best_itineraries(leg_candidates(flights, year=year, **kw))


def itinerary_summary(flights: DataFrame, **kw) -> DataFrame:
    """JN-1: exact facts over all pairs of each trip (no pair enumeration)."""
    return itinerary_pair_summary(leg_candidates(flights, **kw))


def itinerary_k_best(flights: DataFrame, k: int, **kw) -> DataFrame:
    """AGG-6, cut to k: per trip the ``k`` best pairs, sorted, and the exact
    number of all pairs. The lossless form of a trip's list is its two legs
    (``split_legs``): every pair of them is one of the list's."""
    return itinerary_lists(leg_candidates(flights, **kw), k)


def itinerary_whole_lists(flights: DataFrame, **kw) -> DataFrame:
    """AGG-6: per trip all its pairs, sorted, and their number."""
    return itinerary_lists(leg_candidates(flights, **kw), None)


def days_of_week(flights: DataFrame) -> DataFrame:
    """EX-1: days of the week ranked by total arrival delay (mean alongside)."""
    f = require(flights, ["day_of_week", "arr_delay_min"])
    agg = f.groupBy("day_of_week").agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum("arr_delay_min").cast("long").alias("total_arr_delay"),
        F.avg("arr_delay_min").alias("mean_arr_delay"))
    # seven rows at most: the un-partitioned rank is over the aggregate
    w = Window.orderBy(F.col("total_arr_delay").asc(), F.col("day_of_week").asc())
    return agg.withColumn("rank", F.row_number().over(w))


def mean_delay_per_route(flights: DataFrame) -> DataFrame:
    """EX-2: mean arrival delay per origin-destination pair."""
    f = require(flights, ["origin", "dest", "arr_delay_min"])
    return f.groupBy("origin", "dest").agg(
        F.count(F.lit(1)).alias("flights"),
        F.sum("arr_delay_min").cast("long").alias("total_arr_delay"),
        F.avg("arr_delay_min").alias("mean_arr_delay"))


def zipf_fit(flights: DataFrame) -> DataFrame:
    """EX-4: does airport popularity follow Zipf's law?

    Fits log(flights) = a + b * log(rank) by least squares; Zipf means a
    slope near -1 and r2 near 1. The rank runs over the per-airport counts
    (one row per airport), not over flights.
    """
    counts = count_by(unpivot_endpoints(flights), ["airport"], "flights")
    w = Window.orderBy(F.col("flights").desc(), F.col("airport").asc_nulls_last())
    ranked = counts.withColumn("rank", F.row_number().over(w))
    y, x = F.log(F.col("flights").cast("double")), F.log(F.col("rank").cast("double"))
    return ranked.agg(
        F.count(F.lit(1)).alias("airports"),
        F.round(F.regr_slope(y, x), 6).alias("slope"),
        F.round(F.regr_intercept(y, x), 6).alias("intercept"),
        F.round(F.regr_r2(y, x), 6).alias("r2"))
