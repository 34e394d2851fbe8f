"""FLT-1..FLT-5: row filters and the missing-value policies.

* batch jobs drop a row when any field they need is missing (FLT-1, FLT-3,
  FLT-4);
* the streaming ranking jobs count a missing delay as 0 (FLT-2);
* the popularity job keeps everything, even an empty airport code.

All are plain predicates: Catalyst pushes them into the Parquet scan where
the column comes straight from a file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolap.functions.parse import fill_zero


def present(df: DataFrame, cols: Sequence[str]) -> Column:
    """Predicate: every column is non-NULL (and non-empty for text)."""
    cond = F.lit(True)
    for c in cols:
        p = F.col(c).isNotNull()
        if isinstance(df.schema[c].dataType, T.StringType):
            p = p & (F.col(c) != F.lit(""))
        cond = cond & p
    return cond


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-1: keep rows where all ``cols`` are present."""
    return df.filter(present(df, cols))


def zero_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """FLT-2: replace a missing value by 0 in each of ``cols``."""
    return df.select(*[fill_zero(c).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def time_of_day(dep_time: str, noon: int = 1200, part: str = "morning",
                noon_inclusive: bool = False) -> Column:
    """FLT-5: before noon (``< 1200``) or after it.

    The batch rule puts exactly 1200 in neither part; ``noon_inclusive=True``
    is the streaming rule, which sends 1200 to the afternoon.
    """
    t = F.col(dep_time)
    if part == "morning":
        return t < noon
    if part == "afternoon":
        return (t >= noon) if noon_inclusive else (t > noon)
    raise ValueError("part must be 'morning' or 'afternoon'")
