"""PRJ-4 and friends: reshaping rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_endpoints(df: DataFrame, cols: Sequence[str] = ("origin", "dest"),
                      out: str = "airport") -> DataFrame:
    """PRJ-4: one row per endpoint. A flight ORD->ORD yields ORD twice."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out))
