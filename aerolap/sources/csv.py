"""Concise and raw CSV: SRC-2, SRC-3, PRJ-1, PRJ-3, SNK-2, rejected rows.

* ``parse_concise`` turns a column of concise lines (a text file line or a
  stream message) into typed flights (D13, D14, D19). Rejection is by field:
  ``bad_fields`` lists the typed columns whose text could not be read (a bad
  number, an impossible date, undecodable bytes, or beyond the end of a short
  line), ``reject_reason`` names the first fault and ``raw_line`` keeps the
  text of a row with any fault. ``accepted(df, needs)`` drops only rows whose
  *needed* columns are bad. Nothing raises unless ``strict=True``, which fails
  the task on the first faulty row with ``raise_error`` (lazy, JVM-side).
* ``read_concise`` (SRC-3) reads headerless files as text and parses them.
* ``read_raw`` (SRC-2 + PRJ-1) reads headered files whose column order may
  differ per file: each record (``records``: line breaks inside quotes belong
  to it) meets its file's header, and the eleven columns are picked by the names in it. A single CSV read over mixed
  headers would silently mislabel columns.
* ``write_concise`` (SNK-2) writes headerless, CRLF-terminated lines into a
  new folder; the source is never deleted.

CSV dialect: comma, ``"`` quote, ``""`` inside quotes for a quote (RFC 4180,
the reference's parser default); a concise record is one line. Spark's own
default escape is a backslash, so ``escape='"'`` is always set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolap.functions.parse import date_of_parts
from aerolap.schema import CONCISE_DDL, CONCISE_FIELDS, FLIGHT_COLUMNS, RAW_HEADER_NAMES
from aerolap.session import scratch_path
from aerolap.sources.records import records

# Spark's CSV writer trims leading/trailing spaces by default; field text
# must survive a write and a read unchanged, so trimming is off both ways.
CSV_OPTIONS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}

# A quoted field, with doubled quotes inside it.
_QUOTED = '"([^"]|"")*"'


def to_concise_line(*cols: str | Column) -> Column:
    """Fields -> one CSV line (NULL prints as an empty field)."""
    return F.to_csv(F.struct(*cols), CSV_OPTIONS)


def field_count(line: Column) -> Column:
    """Number of CSV fields in a line, quoted commas not counted."""
    return F.size(F.split(F.regexp_replace(line, _QUOTED, ""), ",", -1))


def split_line(lines: DataFrame, line: str, ddl: str, options: dict) -> DataFrame:
    """Adds what ``field_at`` reads, and ``_n``, the number of fields.

    A line with nothing to unquote is split at its commas (``_parts``); the CSV
    parser (``_f``, columns of ``ddl``) reads only the others. Blank lines,
    lines with a line break or a NUL in them and very long ones go to the
    parser too, whose rules for them are not those of a split.
    """
    v = F.col(line)
    # octets are known, characters are counted: only for lines that may be too long
    plain = ((F.octet_length(v) < 20_000) | (F.length(v) < 20_000)) & (F.trim(v) != "")
    for special in ('"', "\n", "\r", "\0"):
        plain = plain & ~F.contains(v, F.lit(special))
    split = lines.select("*", F.when(plain, F.split(v, ",", -1)).alias("_parts"))
    plain = F.col("_parts").isNotNull()
    return split.select("*", F.when(~plain, F.from_csv(v, ddl, options)).alias("_f"),
                        F.when(plain, F.size("_parts")).otherwise(field_count(v)).alias("_n"))


def field_at(place: int, name: str) -> Column:
    """The field of a ``split_line`` row at ``place``, ``name`` in its ``ddl``."""
    return F.coalesce(F.get("_parts", F.lit(place)), F.col(f"_f.{name}"))


# Typed column -> the text fields it is read from.
_READ_FROM = {n: [n] for n in FLIGHT_COLUMNS} | {"flight_date": ["year", "month", "day_of_month"]}
# What parsing reports beside the flight columns.
REPORT_COLUMNS = ["reject_reason", "bad_fields", "raw_line"]


def typed_from_fields(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Eleven text fields -> typed flight columns + ``REPORT_COLUMNS``.

    ``df`` may carry ``missing_fields`` (text fields beyond the end of a short
    line), ``raw_line``, ``fault`` (why a whole file could not be read, up to
    a colon the reject reason) and ``suspect`` (whether any field may hold
    undecodable bytes); without them no field counts as missing, the raw line is
    NULL and every field is looked at.
    """
    missing = (F.col("missing_fields") if "missing_fields" in df.columns
               else F.array().cast("array<string>"))
    raw = F.col("raw_line") if "raw_line" in df.columns else F.lit(None).cast("string")
    fault = F.col("fault") if "fault" in df.columns else F.lit(None).cast("string")
    suspect = F.col("suspect") if "suspect" in df.columns else F.lit(True)
    # Steps of plain projections: what a later step reads more than once is a
    # column of an earlier one, so it is computed once a row (Catalyst does not
    # merge such projections).
    texts = df.select(*keep, raw.alias("_raw"), fault.alias("_fault"), missing.alias("_missing"), suspect.alias("_suspect"),
                      *(F.nullif(F.col(n), F.lit("")).alias(f"_{n}") for n in CONCISE_FIELDS))
    c = {n: F.col(f"_{n}") for n in CONCISE_FIELDS}
    # these casts skip blanks at both ends by themselves
    read = {n: c[n].try_cast("float").try_cast("int") for n in ("dep_delay_min", "arr_delay_min")}
    read |= {n: c[n].try_cast("int") for n in ("dep_time", "day_of_week", *_READ_FROM["flight_date"])}
    numbers = texts.select("*", *(value.alias(f"_{n}_read") for n, value in read.items()))
    garbled = {n: F.coalesce(F.contains(c[n], F.lit("\ufffd")), F.lit(False)) for n in CONCISE_FIELDS}

    def any_of(flags) -> Column:
        out = F.lit(False)
        for f in flags:
            out = out | f
        return out

    unread = {n: c[n].isNotNull() & F.col(f"_{n}_read").isNull() for n in read}
    bad_part = any_of(unread[n] for n in _READ_FROM["flight_date"])
    day = date_of_parts(*(F.col(f"_{n}_read") for n in _READ_FROM["flight_date"]))
    flagged = numbers.select("*", day.alias("_day"), bad_part.alias("_bad_part"),
                             any_of(unread[n] for n in read if n not in _READ_FROM["flight_date"]).alias("_bad_number"),
                             (F.col("_suspect") & any_of(garbled.values())).alias("_garbled"))
    bad_day = F.col("_day").isNull()
    for n in _READ_FROM["flight_date"]:
        bad_day = bad_day & c[n].isNotNull()
    unread["flight_date"] = F.col("_bad_part") | bad_day
    any_bad = (F.size("_missing") > 0) | F.col("_garbled") | F.col("_bad_number") | unread["flight_date"]
    # the list is built by a higher-order function: only for rows with a fault
    bad = F.when(any_bad, F.array_compact(F.array(*(
        F.when(any_of([unread.get(n, F.lit(False)), *(garbled[x] for x in _READ_FROM[n]),
                       *(F.array_contains("_missing", x) for x in _READ_FROM[n])]), F.lit(n))
        for n in FLIGHT_COLUMNS)))).otherwise(F.array().cast("array<string>"))
    reason = (F.when(F.col("_fault").isNotNull(), F.substring_index("_fault", ":", 1))
              .when(F.size("_missing") == len(CONCISE_FIELDS), F.lit("empty message"))
              .when(F.size("_missing") > 0, F.lit("too few fields"))
              .when(F.col("_garbled"), F.lit("bad encoding"))
              .when(F.col("_bad_number") | F.col("_bad_part"), F.lit("bad number"))
              .when(bad_day, F.lit("invalid date")))
    typed = {n: F.col(f"_{n}_read") if n in read else c.get(n) for n in FLIGHT_COLUMNS} | {"flight_date": F.col("_day")}
    named = flagged.select(*keep, *(typed[n].alias(n) for n in FLIGHT_COLUMNS), reason.alias("reject_reason"),
                           bad.alias("bad_fields"), "_raw")
    # Generate barrier: a filter on the report (accepted / rejected) then reads
    # computed columns instead of re-running every cast. It holds column
    # references only: a generator's own expressions are interpreted row by row.
    row = F.struct(*FLIGHT_COLUMNS, "reject_reason", "bad_fields",
                   F.when(F.col("reject_reason").isNotNull(), F.col("_raw")).alias("raw_line"))
    return named.select(*keep, F.inline(F.array(row)))


def strict(df: DataFrame) -> DataFrame:
    """Fail the task on the first row with any fault (a filter, so that no
    projection can prune the check)."""
    fault = F.raise_error(F.concat(F.lit("rejected flight row: "), F.col("reject_reason")))
    return df.filter(F.when(F.col("reject_reason").isNotNull(), fault.cast("boolean")).otherwise(F.lit(True)))


_fail_on_faults = strict


def parse_concise(lines: DataFrame, value_col: str = "value", keep: Sequence[str] = (),
                  strict: bool = False) -> DataFrame:
    """PRJ-3: concise CSV lines -> typed flights + ``REPORT_COLUMNS``.

    Only the first record of a line is used (a stream message holds one).
    """
    v = F.col(value_col)
    # bytes that are not UTF-8 become U+FFFD on the way, too
    v = F.when(F.contains(v, F.lit("\r")) | ~F.is_valid_utf8(v), F.regexp_replace(v, "\r$", "")).otherwise(v)
    # Generate barrier: what makes the lines (joins, a writer of CSV) and what
    # parses them stay two generated functions, each small enough to be compiled
    made = lines.select(*keep, v.alias("_line"))
    fenced = made.select(*keep, F.inline(F.array(F.struct(F.col("_line").alias("raw_line")))))
    split = split_line(fenced, "raw_line", CONCISE_DDL, CSV_OPTIONS)
    names = F.array(*map(F.lit, CONCISE_FIELDS))
    blank = F.col("raw_line").isNull() | (F.trim(F.col("raw_line")) == "")
    missing = (F.when(blank, names).when(F.col("_n") >= len(CONCISE_FIELDS), F.array().cast("array<string>"))
               .otherwise(F.slice(names, F.col("_n") + 1, len(CONCISE_FIELDS))))
    suspect = F.coalesce(F.contains("raw_line", F.lit("\ufffd")), F.lit(False))
    out = typed_from_fields(split.select(*keep, "raw_line", missing.alias("missing_fields"), suspect.alias("suspect"),
                                         *(field_at(i, n).alias(n) for i, n in enumerate(CONCISE_FIELDS))), keep=keep)
    return _fail_on_faults(out) if strict else out


def accepted(parsed: DataFrame, needs: Sequence[str] | None = None) -> DataFrame:
    """Rows whose ``needs`` columns (default: all) were read, reports dropped.

    A fault in a column that the job does not name costs it no row; the bad
    value itself is NULL.
    """
    if needs is None:
        good = F.col("reject_reason").isNull()
    else:
        good = ~F.arrays_overlap("bad_fields", F.array(*map(F.lit, needs)))
    return parsed.filter(good).drop(*REPORT_COLUMNS)


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull())


def read_concise(spark: SparkSession, path: str | Sequence[str],
                 strict: bool = False) -> DataFrame:
    """SRC-3: headerless concise files (path, folder or glob) -> parsed rows.

    Text lines are split by Spark's line reader (``\\n``, ``\\r\\n``), so the
    files split across tasks like any text input.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return parse_concise(spark.read.text(paths), strict=strict)


def write_concise(df: DataFrame, path: str, crlf: bool = True,
                  mode: str = "errorifexists") -> None:
    """SNK-2: headerless concise CSV (CRLF line ends like Python's csv module)."""
    line = to_concise_line(*CONCISE_FIELDS)
    if crlf:
        line = F.concat(line, F.lit("\r"))
    df.select(line.alias("value")).write.mode(mode).text(path)


def write_raw(df: DataFrame, path: str, columns: Sequence[str],
              mode: str = "errorifexists") -> None:
    """Headered raw CSV with the given column order (raw header names).

    ``columns`` are raw names (``RAW_HEADER_NAMES`` plus any extra column of
    ``df`` by its own name); used to produce raw-layout inputs.
    """
    name_of = dict(zip(RAW_HEADER_NAMES, CONCISE_FIELDS))
    sel = [F.col(name_of.get(c, c)).alias(c) for c in columns]
    (df.select(*sel).write.mode(mode).option("header", True)
     .options(**CSV_OPTIONS).csv(path))


def _file_headers(spark: SparkSession, paths: list[str], glob: str | None) -> DataFrame:
    """(file, header) of every file, from a distributed read of first lines."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(paths).select(F.col("_metadata.file_path").alias("file"))

    def first_lines(batches):
        import pandas as pd

        from aerolap.sources.files import first_record, open_binary

        for pdf in batches:
            heads = []
            for p in pdf["file"]:
                with open_binary(p) as fh:
                    heads.append(first_record(fh))
            yield pd.DataFrame({"file": pdf["file"], "header": heads})

    return files.mapInPandas(first_lines, "file string, header string").where("header IS NOT NULL")


def fields_by_header(lines: DataFrame, headers: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``header, value`` lines -> the eleven text fields by name.

    Adds ``missing_fields`` and ``raw_line`` for ``typed_from_fields``. One
    parse for all layouts: values are split by position, then each field takes
    the position that its line's header gives it. A layout without one of the
    eleven columns raises.
    """
    places: dict[str, list[int]] = {}
    width = 1
    for h in headers:
        names = _split_header(h)
        lacking = [c for c in RAW_HEADER_NAMES if c not in names]
        if lacking:
            raise ValueError(f"raw files with header {h[:200]!r} lack columns {lacking}")
        places[h] = [names.index(c) for c in RAW_HEADER_NAMES]
        width = max(width, len(names))
    ddl = ", ".join(f"c{i} STRING" for i in range(width))
    layout = F.lit(None).cast("int")
    for n, h in enumerate(places):
        layout = F.when(F.col("header") == F.lit(h), F.lit(n)).otherwise(layout)
    staged = split_line(lines.select(*keep, "value", layout.alias("_layout")), "value", ddl,
                        CSV_OPTIONS | {"maxColumns": str(max(20480, 2 * width))})

    def by_layout(make):
        out = F.lit(None)
        for n, at in enumerate(places.values()):
            out = F.when(F.col("_layout") == n, make(at)).otherwise(out)
        return out

    def missing(at: list[int]) -> Column:
        return F.when(F.col("_n") > max(at), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*(
            F.when(F.col("_n") <= at[i], F.lit(n)) for i, n in enumerate(CONCISE_FIELDS)))))

    return staged.select(
        *keep,
        *(by_layout(lambda at, i=i: F.nullif(field_at(at[i], f"c{at[i]}"), F.lit(""))).alias(n)
          for i, n in enumerate(CONCISE_FIELDS)),
        by_layout(missing).alias("missing_fields"),
        F.col("value").alias("raw_line"))


def read_raw(spark: SparkSession, path: str | Sequence[str], glob: str | None = "*.csv",
             exclude_suffix: str | None = ".concise.csv") -> DataFrame:
    """SRC-2 + PRJ-1 + FLT-7: headered raw files -> the eleven text fields.

    Columns are resolved by name in each file. A record may span lines inside
    quotes (``records``); the header is a file's first record, by position, and
    a byte order mark is none of its text. Empty files have no rows.
    ``exclude_suffix`` skips files already converted (``*.concise.csv``). The driver
    receives the distinct headers (a handful of layouts); the file -> header
    table is stored, and broadcast only within Spark's check of its real size.
    """
    paths = [path] if isinstance(path, str) else list(path)
    stored = scratch_path(spark, "headers")
    _file_headers(spark, paths, glob).write.parquet(stored)
    heads = spark.read.schema("file string, header string").parquet(stored)
    if exclude_suffix:
        heads = heads.filter(~F.col("file").endswith(exclude_suffix))
    headers = [r.header for r in heads.select("header").distinct().collect()]
    if not headers:
        raise ValueError(f"no raw CSV files under {path}")
    lines = (records(spark, paths, glob).where("number > 1").join(heads, "file")
             .filter(F.trim("value") != ""))
    return fields_by_header(lines, headers)


def _split_header(header: str) -> list[str]:
    import csv

    return next(csv.reader([header]))
