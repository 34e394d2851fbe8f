"""SRC-4 / SNK-1: ``key<TAB>value`` text, composite parts joined by commas.

The reference's jobs hand results to each other, and to users, as lines like
``ORD<TAB>AA,1234``. Here it is only an export/import format: results stay
DataFrames (Parquet by default) between steps.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Characters that would end a part, and NULL, as a backslash and a letter; the
# backslash itself comes first when writing and last when reading.
_ESCAPES = [("\\", "\\b"), (",", "\\c"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r")]
_NULL = "\\N"


def escape_part(c: Column) -> Column:
    c = c.cast("string")
    for plain, written in _ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return F.coalesce(c, F.lit(_NULL))


def unescape_part(c: Column) -> Column:
    text = c
    for plain, written in reversed(_ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return F.when(c != F.lit(_NULL), text)


def kv_line(keys: Sequence[str], values: Sequence[str]):
    """FN-7: ``k1,k2<TAB>v1,v2`` as one string column.

    Every part is written, a NULL as ``\\N``; a comma, tab, line break or
    backslash inside a part is escaped, so reading gives the same parts.
    """
    side = lambda cols: F.concat_ws(",", *(escape_part(F.col(c)) for c in cols))
    return F.concat_ws("\t", side(keys), side(values))


def write_kv_text(df: DataFrame, path: str, keys: Sequence[str], values: Sequence[str],
                  mode: str = "errorifexists") -> None:
    df.select(kv_line(keys, values).alias("value")).write.mode(mode).text(path)


def read_kv_text(spark: SparkSession, path: str, key_names: Sequence[str],
                 value_names: Sequence[str], types: dict[str, str] | None = None
                 ) -> DataFrame:
    """Split each line at the first tab, then each side at commas.

    ``types`` casts named parts (``try_cast``: a bad value becomes NULL). A
    part that a short line lacks is NULL.
    """
    types = types or {}
    kv = F.split(F.col("value"), "\t", 2)
    k = F.split(F.get(kv, F.lit(0)), ",", -1)
    v = F.split(F.get(kv, F.lit(1)), ",", -1)
    cols = ([unescape_part(F.get(k, F.lit(i))).alias(n) for i, n in enumerate(key_names)]
            + [unescape_part(F.get(v, F.lit(i))).alias(n) for i, n in enumerate(value_names)])
    df = spark.read.text(path).select(*cols)
    return df.select(*[F.col(n).try_cast(types[n]).alias(n) if n in types else F.col(n)
                       for n in df.columns])
