"""AGG-1..3: exact grouped counts and sums.

All are ``groupBy().agg()``: a partial HashAggregate runs before the shuffle
(the map-side combine the reference's batch jobs never configured), so what
crosses the network is one row per key per task. Sums are BIGINT.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    """AGG-1: rows per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def sum_by(df: DataFrame, keys: Sequence[str], value: str,
           out: str = "total") -> DataFrame:
    """AGG-2 / AGG-3: sum of ``value`` per (possibly composite) key."""
    return df.groupBy(*keys).agg(F.sum(value).cast("long").alias(out))
