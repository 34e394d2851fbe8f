"""Text-to-value parsing and small scalar helpers.

Every function returns a ``Column`` built from Spark built-ins, so the work
stays inside whole-stage codegen. ANSI mode is on by default in Spark 4, where
a failed ``cast`` raises; parsing therefore always uses ``try_cast`` and bad
input becomes NULL (the caller decides whether that row is rejected).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _is_text(c: Column, dtype: T.DataType | None) -> bool:
    return dtype is None or isinstance(dtype, T.StringType)


def trunc_minutes(c: ColumnOrName, dtype: T.DataType | None = None) -> Column:
    """FN-1: delay text (or number) -> 32-bit float -> INT, truncated.

    ``'12.99' -> 12``, ``'-3.7' -> -3``, ``''``/garbage/NaN -> NULL. The value
    passes through FLOAT on purpose: the jobs parse delays as 32-bit floats.
    """
    c = _col(c)
    if _is_text(c, dtype):
        c = F.nullif(F.trim(c), F.lit(""))
    return c.try_cast("float").try_cast("int")


def parse_int(c: ColumnOrName) -> Column:
    """FN-2: integer text -> INT (``'0930' -> 930``), NULL when not a number."""
    return F.nullif(F.trim(_col(c)), F.lit("")).try_cast("int")


def flight_date(year: ColumnOrName, month: ColumnOrName,
                day: ColumnOrName) -> Column:
    """FN-3: DATE from year, month and day parts; impossible dates -> NULL.

    Each part is first parsed as an integer so ``'05'`` and ``'5'`` agree;
    ``make_date`` would raise under ANSI, the string cast does not.
    """
    return date_of_parts(*(parse_int(x) for x in (year, month, day)))


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """``flight_date`` of parts that are integers already.

    Days that every month has are made from the numbers; only the others (and
    unusual years) go through text, which tells impossible dates.
    """
    usual = year.between(1000, 9999) & month.between(1, 12) & day.between(1, 28)
    return F.when(usual, F.make_date(year, month, day)).otherwise(F.concat_ws("-", year, month, day).try_cast("date"))


def format_day(c: ColumnOrName) -> Column:
    """FN-5: DATE -> ``yyyy-MM-dd`` text."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def fill_zero(c: ColumnOrName) -> Column:
    """FLT-2: missing delay counts as 0 (the streaming jobs' rule)."""
    return F.coalesce(_col(c), F.lit(0))


def dep_label(airport: ColumnOrName, dep_time: ColumnOrName) -> Column:
    """PRJ-11 / FN-8: ``AIRPORT@HHMM`` with the time zero-padded to 4 digits.

    NULL when either part is missing (no half-built label).
    """
    hhmm = F.lpad(_col(dep_time).cast("string"), 4, "0")
    return F.concat(_col(airport), F.lit("@"), hhmm)


def event_time(day: ColumnOrName, dep_time: ColumnOrName | None = None) -> Column:
    """Event timestamp = date + HH hours + MM minutes, within the day (``2400``
    and later count as its last second)."""
    secs = F.unix_date(_col(day)).cast("long") * F.lit(86400)
    if dep_time is not None:
        t = F.coalesce(_col(dep_time), F.lit(0)).cast("long")
        secs = secs + F.least((F.floor(t / 100) * 60 + F.pmod(t, F.lit(100))) * 60, F.lit(86399))
    return F.timestamp_seconds(secs)


def day_of_instant(ts: ColumnOrName) -> Column:
    """TIMESTAMP instant -> its UTC calendar day, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(_col(ts)) / 86400).cast("int"))


def ntz_from_instant(ts: ColumnOrName) -> Column:
    """TIMESTAMP instant -> the TIMESTAMP_NTZ of its UTC wall time.

    Built from epoch seconds with date arithmetic only, so the result does
    not depend on the session time zone (a plain cast would).
    """
    secs = F.unix_seconds(_col(ts))
    day = F.date_from_unix_date(F.floor(secs / 86400).cast("int"))
    rem = F.pmod(secs, F.lit(86400))
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day),
        F.floor(rem / 3600).cast("int"), F.floor(F.pmod(rem, F.lit(3600)) / 60).cast("int"),
        F.pmod(rem, F.lit(60)).cast("decimal(8,6)"))


_TWO32 = 4294967296
_TWO31 = 2147483648


def pack_min_key(hi: ColumnOrName, lo: ColumnOrName) -> Column:
    """Pack two INTs into one BIGINT whose order is (hi, lo) lexicographic.

    ``min`` over the packed value is a HashAggregate (``min(struct)`` would be
    a SortAggregate) and is exact for every pair of 32-bit integers.
    """
    # hi in the upper 32 bits, lo + 2^31 (0 .. 2^32-1) in the lower ones. A
    # shift and an OR, not a sum: Catalyst regroups constant terms of sums,
    # which can overflow an intermediate (ANSI raises) at the int extremes.
    low = _col(lo).cast("long") + F.lit(_TWO31)
    return F.shiftleft(_col(hi).cast("long"), 32).bitwiseOR(low)


def unpack_hi(c: ColumnOrName) -> Column:
    return F.shiftright(_col(c), 32).cast("int")


def unpack_lo(c: ColumnOrName) -> Column:
    return ((_col(c).bitwiseAND(F.lit(_TWO32 - 1))) - F.lit(_TWO31)).cast("int")
