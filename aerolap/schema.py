"""Flight record layouts.

Three layouts appear in the reference's data flow:

* raw on-time CSV (headered, any column order; selected by name),
* the *concise* line: headerless CSV with exactly eleven text fields in a fixed
  order (the input of every job, also the payload of a stream message),
* the typed flight frame every operator here consumes.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The eleven raw-file column names, in the order of the concise
# line. They must equal the names in the published on-time files.
RAW_HEADER_NAMES = [
    "Carrier", "Origin", "Dest", "DepDelayMinutes", "ArrDelayMinutes",
    "DepTime", "Year", "Month", "DayofMonth", "DayOfWeek", "AirlineID",
]

# Our names for the concise fields, same order.
CONCISE_FIELDS = [
    "carrier", "origin", "dest", "dep_delay_min", "arr_delay_min",
    "dep_time", "year", "month", "day_of_month", "day_of_week", "airline_id",
]

CONCISE_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType(), True) for n in CONCISE_FIELDS])
CONCISE_DDL = ", ".join(f"{n} STRING" for n in CONCISE_FIELDS)

# The typed flight frame. Delays are whole minutes, truncated toward zero the
# way the jobs parse them; dep_time is HHMM as an integer.
FLIGHT_SCHEMA = T.StructType([
    T.StructField("carrier", T.StringType(), True),
    T.StructField("origin", T.StringType(), True),
    T.StructField("dest", T.StringType(), True),
    T.StructField("dep_delay_min", T.IntegerType(), True),
    T.StructField("arr_delay_min", T.IntegerType(), True),
    T.StructField("dep_time", T.IntegerType(), True),
    T.StructField("flight_date", T.DateType(), True),
    T.StructField("day_of_week", T.IntegerType(), True),
    T.StructField("airline_id", T.StringType(), True),
])
FLIGHT_COLUMNS = [f.name for f in FLIGHT_SCHEMA.fields]
