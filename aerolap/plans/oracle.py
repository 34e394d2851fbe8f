"""DuckDB text of every registered query, for the side-by-side check.

The flight CTE is the fixture view over the test tables, written expression
for expression like ``aerolap.sources.tables``. Traps handled here: DuckDB
rounds on ``CAST(x AS INT)`` (Spark truncates), sums integers into HUGEINT,
numbers ``row_number`` as BIGINT, and ``date - interval`` gives a timestamp.
"""

from __future__ import annotations

from collections.abc import Sequence

_FLIGHT_JOIN = """
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation dn ON c_nationkey = dn.n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation so ON s_nationkey = so.n_nationkey
  JOIN part ON l_partkey = p_partkey"""

_DEP_DELAY = "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice / 1000.0 END"
_ARR_DELAY = "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END"
_DEP_TIME = ("CASE WHEN l_tax = 0.08 THEN NULL ELSE "
             "CAST(((l_partkey * 7 + l_suppkey * 13 + l_orderkey) % 24) * 100 "
             "+ (l_orderkey * 11 + l_linenumber) % 60 AS INTEGER) END")


_DEP_HUNDREDTHS = ("CASE WHEN l_linenumber = 7 THEN NULL ELSE "
                   "CAST(round(l_extendedprice * 100) AS BIGINT) // 1000 END")
_ARR_HUNDREDTHS = ("CASE WHEN l_linenumber = 6 THEN NULL ELSE "
                   "CAST(round(l_quantity * 100) AS BIGINT) END")


def _two_decimals(h: str) -> str:
    return f"CAST(({h}) // 100 AS VARCHAR) || '.' || lpad(CAST(({h}) % 100 AS VARCHAR), 2, '0')"


def trunc_sql(x: str) -> str:
    """FN-1 in DuckDB: through FLOAT, then truncate (a plain cast rounds)."""
    return f"CAST(trunc(CAST({x} AS FLOAT)) AS INTEGER)"


FLIGHTS = f"""flights AS (
  SELECT p_brand AS carrier, so.n_name AS origin, dn.n_name AS dest,
    {trunc_sql(_DEP_DELAY)} AS dep_delay_min,
    {trunc_sql(_ARR_DELAY)} AS arr_delay_min,
    {_DEP_TIME} AS dep_time,
    CAST(l_shipdate AS DATE) AS flight_date,
    CAST(isodow(CAST(l_shipdate AS DATE)) AS INTEGER) AS day_of_week,
    CAST(l_suppkey AS VARCHAR) AS airline_id,
    CAST(l_orderkey % 4 AS INTEGER) AS bucket{_FLIGHT_JOIN}
)"""

# The concise text fields, as rendered by ``tables.concise_fields``.
CONCISE = f"""concise AS (
  SELECT p_brand AS carrier, so.n_name AS origin, dn.n_name AS dest,
    {_two_decimals(_DEP_HUNDREDTHS)} AS dep_delay_min,
    {_two_decimals(_ARR_HUNDREDTHS)} AS arr_delay_min,
    lpad(CAST({_DEP_TIME} AS VARCHAR), 4, '0') AS dep_time,
    CAST(year(l_shipdate) AS VARCHAR) AS year,
    CAST(month(l_shipdate) AS VARCHAR) AS month,
    CAST(day(l_shipdate) AS VARCHAR) AS day_of_month,
    CAST(isodow(CAST(l_shipdate AS DATE)) AS VARCHAR) AS day_of_week,
    CAST(l_suppkey AS VARCHAR) AS airline_id,
    CAST(l_orderkey % 4 AS INTEGER) AS bucket{_FLIGHT_JOIN}
)"""

# The concise fields parsed back to typed flights (PRJ-3 in DuckDB).
PARSED = f"""parsed AS (
  SELECT carrier, origin, dest,
    {trunc_sql("dep_delay_min")} AS dep_delay_min,
    {trunc_sql("arr_delay_min")} AS arr_delay_min,
    CAST(dep_time AS INTEGER) AS dep_time,
    make_date(CAST(year AS INTEGER), CAST(month AS INTEGER),
              CAST(day_of_month AS INTEGER)) AS flight_date,
    CAST(day_of_week AS INTEGER) AS day_of_week,
    airline_id, bucket
  FROM concise
)"""


def with_flights(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((FLIGHTS,) + ctes) + "\n" + body


def with_parsed(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((CONCISE, PARSED) + ctes) + "\n" + body


def _order(by: str, item: Sequence[str], ascending: bool) -> str:
    first = f"{by} {'ASC' if ascending else 'DESC'} NULLS LAST"
    return ", ".join([first] + [f"{c} ASC NULLS LAST" for c in item])


def topk_sql(source: str, k: int, by: str, group: Sequence[str] = (),
             item: Sequence[str] = (), ascending: bool = True,
             ties: str = "rows", rank_col: str = "rank") -> str:
    """SELECT text of ``topk.top_k`` over the relation ``source``."""
    group, item = list(group), list(item)
    if ties == "distinct":
        keys = ", ".join(group + [by])
        if len(item) == 1:
            source = (f"(SELECT {keys}, min({item[0]}) AS {item[0]} "
                      f"FROM {source} GROUP BY {keys})")
        else:
            source = (f"(SELECT {keys}, arg_min_item.* FROM (SELECT {keys}, "
                      f"min({{{', '.join(f'{c!r}: {c}' for c in item)}}}) AS arg_min_item "
                      f"FROM {source} GROUP BY {keys}))")
    part = f"PARTITION BY {', '.join(group)} " if group else ""
    cols = ", ".join(group + item + [by])
    rn = f"CAST(row_number() OVER ({part}ORDER BY {_order(by, item, ascending)}) AS INTEGER)"
    return (f"SELECT {cols}, {rank_col} FROM (SELECT {cols}, {rn} AS {rank_col} "
            f"FROM {source} AS _s) AS _r WHERE {rank_col} <= {k}")


def top_per_group_sql(group: Sequence[str], item: Sequence[str], k: int = 10,
                      delay_col: str = "dep_delay_min", out: str = "total_dep_delay",
                      ties: str = "rows", missing: str = "drop",
                      source: str = "flights") -> str:
    keys = list(group) + list(item)
    if missing == "zero":
        val = f"coalesce({delay_col}, 0)"
        where = ""
    else:
        val = delay_col
        where = "WHERE " + " AND ".join(
            [f"{c} IS NOT NULL AND {c} <> ''" for c in keys] + [f"{delay_col} IS NOT NULL"])
    sums = (f"(SELECT {', '.join(keys)}, CAST(sum({val}) AS BIGINT) AS {out} "
            f"FROM {source} {where} GROUP BY {', '.join(keys)})")
    return topk_sql(sums, k, out, group, item, ascending=True, ties=ties)


TOP_AIRPORTS = with_flights(topk_sql(
    "(SELECT airport, CAST(count(*) AS BIGINT) AS flights FROM "
    "(SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights) "
    "GROUP BY airport)", 10, "flights", item=["airport"], ascending=False))

TOP_AIRLINES = with_flights(topk_sql(
    "(SELECT airline_id, CAST(sum(arr_delay_min) AS BIGINT) AS total_arr_delay "
    "FROM flights WHERE airline_id IS NOT NULL AND airline_id <> '' "
    "AND arr_delay_min IS NOT NULL GROUP BY airline_id)",
    10, "total_arr_delay", item=["airline_id"]))

TOP_CARRIERS_PER_AIRPORT = with_flights(top_per_group_sql(["origin"], ["carrier"]))
TOP_DESTS_PER_AIRPORT = with_flights(top_per_group_sql(["origin"], ["dest"]))
TOP_CARRIERS_PER_ROUTE = with_flights(top_per_group_sql(["origin", "dest"], ["carrier"]))
CARRIERS_PER_ROUTE_ARRIVAL = with_flights(top_per_group_sql(
    ["origin", "dest"], ["carrier"], delay_col="arr_delay_min", out="total_arr_delay"))


def legs_sql(delay_col: str = "arr_delay_min", noon_inclusive: bool = False,
             year: int | None = None, source: str = "flights") -> tuple[str, str]:
    """CTE bodies ``leg1``, ``leg2`` of ``itinerary.split_legs``."""
    need = (f"origin IS NOT NULL AND origin <> '' AND dest IS NOT NULL AND dest <> '' "
            f"AND dep_time IS NOT NULL AND flight_date IS NOT NULL "
            f"AND {delay_col} IS NOT NULL")
    after = ">=" if noon_inclusive else ">"
    y1 = f" AND year(flight_date) = {year}" if year is not None else ""
    y2 = (f" AND year(CAST(flight_date - INTERVAL 2 DAY AS DATE)) = {year}"
          if year is not None else "")
    leg1 = (f"leg1 AS (SELECT origin AS src, dest AS mid, flight_date AS start_date, "
            f"dep_time AS dep1, {delay_col} AS delay1 FROM {source} "
            f"WHERE {need} AND dep_time < 1200{y1})")
    leg2 = (f"leg2 AS (SELECT origin AS mid, dest AS dst, "
            f"CAST(flight_date - INTERVAL 2 DAY AS DATE) AS start_date, "
            f"dep_time AS dep2, {delay_col} AS delay2 FROM {source} "
            f"WHERE {need} AND dep_time {after} 1200{y2})")
    return leg1, leg2


# All pairs, enumerated: fine for the oracle at test scale only.
_PAIRS = ("pairs AS (SELECT l1.start_date, src, l1.mid, dst, dep1, dep2, delay1, delay2, "
          "CAST(delay1 AS BIGINT) + delay2 AS total_delay FROM leg1 l1 JOIN leg2 l2 "
          "ON l1.mid = l2.mid AND l1.start_date = l2.start_date)")


def itinerary_best_sql(year: int | None = None, parsed: bool = False, **kw) -> str:
    leg1, leg2 = legs_sql(year=year, source="parsed" if parsed else "flights", **kw)
    body = ("SELECT start_date, src, mid, dst, dep1, dep2, delay1, delay2, total_delay "
            "FROM (SELECT *, row_number() OVER (PARTITION BY start_date, src, mid, dst "
            "ORDER BY total_delay, dep1, dep2) AS _rn FROM pairs) WHERE _rn = 1")
    return (with_parsed if parsed else with_flights)(body, leg1, leg2, _PAIRS)


def itinerary_summary_sql(**kw) -> str:
    leg1, leg2 = legs_sql(**kw)
    body = ("SELECT start_date, src, mid, dst, CAST(count(*) AS BIGINT) AS n_pairs, "
            "CAST(min(total_delay) AS BIGINT) AS min_total, "
            "CAST(max(total_delay) AS BIGINT) AS max_total, "
            "CAST(sum(total_delay) AS BIGINT) AS sum_total "
            "FROM pairs GROUP BY start_date, src, mid, dst")
    return with_flights(body, leg1, leg2, _PAIRS)


# A trip's whole list.
_WHOLE_LISTS = ("SELECT start_date, src, mid, dst, CAST(count(*) AS BIGINT) AS n_pairs, "
                "list({'total': total_delay, 'dep1': dep1, 'dep2': dep2} "
                "ORDER BY total_delay, dep1, dep2) AS pairs FROM pairs GROUP BY start_date, src, mid, dst")


def itinerary_lists_sql(k: int | None = 10, source_ctes: Sequence[str] | None = None,
                        extra_key: Sequence[str] = (), **kw) -> str:
    leg1, leg2 = legs_sql(**kw)
    if k is None:
        return with_flights(_WHOLE_LISTS, leg1, leg2, _PAIRS)
    body = (f"SELECT start_date, src, mid, dst, CAST(count(*) AS BIGINT) AS n_pairs, "
            f"list({{'total': total_delay, 'dep1': dep1, 'dep2': dep2}} "
            f"ORDER BY total_delay, dep1, dep2) FILTER (WHERE _rn <= {k}) AS pairs "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY start_date, src, mid, dst "
            f"ORDER BY total_delay, dep1, dep2, delay1) AS _rn FROM pairs) "
            f"GROUP BY start_date, src, mid, dst")
    return with_flights(body, leg1, leg2, _PAIRS)


def itinerary_labels_sql() -> str:
    leg1, leg2 = legs_sql()
    lab1 = "src || '@' || lpad(CAST(dep1 AS VARCHAR), 4, '0')"
    lab2 = "mid || '@' || lpad(CAST(dep2 AS VARCHAR), 4, '0')"
    day = "strftime(start_date, '%Y-%m-%d')"
    body = (f"SELECT {day} AS day, {lab1} AS leg1, {lab2} AS leg2, dst, "
            f"{day} || ',' || {lab1} || ',' || {lab2} || ',' || dst AS path, total_delay "
            f"FROM (SELECT *, row_number() OVER (PARTITION BY start_date, src, mid, dst "
            f"ORDER BY total_delay, dep1, dep2) AS _rn FROM pairs) WHERE _rn = 1")
    return with_flights(body, leg1, leg2, _PAIRS)


DAYS_OF_WEEK = with_flights(
    "SELECT day_of_week, flights, total_arr_delay, mean_arr_delay, "
    "CAST(row_number() OVER (ORDER BY total_arr_delay, day_of_week) AS INTEGER) AS rank "
    "FROM (SELECT day_of_week, CAST(count(*) AS BIGINT) AS flights, "
    "CAST(sum(arr_delay_min) AS BIGINT) AS total_arr_delay, "
    "avg(arr_delay_min) AS mean_arr_delay FROM flights "
    "WHERE day_of_week IS NOT NULL AND arr_delay_min IS NOT NULL GROUP BY day_of_week)")

MEAN_DELAY_PER_ROUTE = with_flights(
    "SELECT origin, dest, CAST(count(*) AS BIGINT) AS flights, "
    "CAST(sum(arr_delay_min) AS BIGINT) AS total_arr_delay, "
    "avg(arr_delay_min) AS mean_arr_delay FROM flights "
    "WHERE origin IS NOT NULL AND origin <> '' AND dest IS NOT NULL AND dest <> '' "
    "AND arr_delay_min IS NOT NULL GROUP BY origin, dest")

ZIPF_FIT = with_flights(
    "SELECT CAST(count(*) AS BIGINT) AS airports, "
    "round(regr_slope(ln(flights), ln(rank)), 6) AS slope, "
    "round(regr_intercept(ln(flights), ln(rank)), 6) AS intercept, "
    "round(regr_r2(ln(flights), ln(rank)), 6) AS r2 "
    "FROM (SELECT airport, flights, row_number() OVER (ORDER BY flights DESC, "
    "airport ASC NULLS LAST) AS rank FROM (SELECT airport, count(*) AS flights FROM "
    "(SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights) "
    "GROUP BY airport))")


# --- operators on the text path (concise lines -> parsed) ---------------------

PARSED_COLS = ("carrier, origin, dest, dep_delay_min, arr_delay_min, dep_time, "
               "flight_date, day_of_week, airline_id")

PARSE_MESSAGE = with_parsed(
    f"SELECT {PARSED_COLS}, bucket, CAST(NULL AS VARCHAR) AS reject_reason FROM parsed")

PARSED_NO_BUCKET = with_parsed(
    f"SELECT {PARSED_COLS}, CAST(NULL AS VARCHAR) AS reject_reason FROM parsed")

# Every flight twice (both layouts), and the three header-like rows of each.
_LIKE_HEADER = (
    "SELECT 'Carrier' AS carrier, 'Origin' AS origin, 'Dest' AS dest, CAST(NULL AS INTEGER) AS dep_delay_min, "
    "CAST(NULL AS INTEGER) AS arr_delay_min, CAST(NULL AS INTEGER) AS dep_time, CAST(NULL AS DATE) AS flight_date, "
    "CAST(NULL AS INTEGER) AS day_of_week, 'AirlineID' AS airline_id, 'bad number' AS reject_reason FROM range(6)")
CSV_MULTILINE = with_parsed(
    f"SELECT {PARSED_COLS}, CAST(NULL AS VARCHAR) AS reject_reason FROM parsed CROSS JOIN range(2)"
    f" UNION ALL {_LIKE_HEADER}")

ZIP_MEMBERS = with_parsed(
    f"SELECT {PARSED_COLS}, CAST(NULL AS VARCHAR) AS reject_reason FROM parsed UNION ALL "
    + "SELECT " + ", ".join(f"CAST(NULL AS {'DATE' if c == 'flight_date' else t}) AS {c}" for t, cs in (
        ("VARCHAR", "carrier origin dest"), ("INTEGER", "dep_delay_min arr_delay_min dep_time flight_date day_of_week"),
        ("VARCHAR", "airline_id")) for c in cs.split())
    + ", 'unreadable archive' AS reject_reason FROM range(2)")

TRUNC_MINUTES = with_parsed(
    f"SELECT dep_delay_min AS dep_delay_text, {trunc_sql('dep_delay_min')} AS dep_minutes, "
    f"arr_delay_min AS arr_delay_text, {trunc_sql('arr_delay_min')} AS arr_minutes "
    f"FROM concise")

DATE_PARTS = with_parsed(
    "SELECT year, month, day_of_month, d AS flight_date, "
    "CAST(d - INTERVAL 2 DAY AS DATE) AS two_days_before, "
    "strftime(d, '%Y-%m-%d') AS day_text FROM (SELECT year, month, day_of_month, "
    "make_date(CAST(year AS INTEGER), CAST(month AS INTEGER), "
    "CAST(day_of_month AS INTEGER)) AS d FROM concise)")

_ALL_FLIGHT_COLS = ("carrier, origin, dest, dep_delay_min, arr_delay_min, dep_time, "
                    "flight_date, day_of_week, airline_id, bucket")

FILTER_REQUIRED = with_flights(
    f"SELECT {_ALL_FLIGHT_COLS} FROM flights WHERE origin IS NOT NULL AND origin <> '' "
    "AND carrier IS NOT NULL AND carrier <> '' AND dep_delay_min IS NOT NULL "
    "AND dep_time IS NOT NULL AND flight_date IS NOT NULL")

FILL_ZERO = with_flights(
    "SELECT origin, carrier, coalesce(dep_delay_min, 0) AS dep_delay_min, "
    "coalesce(arr_delay_min, 0) AS arr_delay_min FROM flights")

UNPIVOT_ENDPOINTS = with_flights(
    "SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights")

COUNT_BY_KEY = with_flights(
    "SELECT airport, CAST(count(*) AS BIGINT) AS flights FROM "
    "(SELECT origin AS airport FROM flights UNION ALL SELECT dest FROM flights) "
    "GROUP BY airport")

SUM_BY_KEY = with_flights(
    "SELECT airline_id, CAST(sum(arr_delay_min) AS BIGINT) AS total_arr_delay "
    "FROM flights WHERE airline_id IS NOT NULL AND airline_id <> '' "
    "AND arr_delay_min IS NOT NULL GROUP BY airline_id")

SUM_BY_COMPOSITE_KEY = with_flights(
    "SELECT origin, dest, carrier, CAST(sum(dep_delay_min) AS BIGINT) AS total_dep_delay "
    "FROM flights WHERE origin IS NOT NULL AND origin <> '' AND dest IS NOT NULL "
    "AND dest <> '' AND carrier IS NOT NULL AND carrier <> '' "
    "AND dep_delay_min IS NOT NULL GROUP BY origin, dest, carrier")

TOPK_DESC = with_flights(topk_sql(
    "(SELECT origin, dest, CAST(count(*) AS BIGINT) AS flights FROM flights "
    "GROUP BY origin, dest)", 10, "flights", item=["origin", "dest"], ascending=False))

TOPK_ASC = with_flights(topk_sql(
    "(SELECT origin, dest, carrier, CAST(sum(dep_delay_min) AS BIGINT) AS total_dep_delay "
    "FROM flights WHERE origin IS NOT NULL AND origin <> '' AND dest IS NOT NULL "
    "AND dest <> '' AND carrier IS NOT NULL AND carrier <> '' "
    "AND dep_delay_min IS NOT NULL GROUP BY origin, dest, carrier)",
    10, "total_dep_delay", item=["origin", "dest", "carrier"]))

TOPK_ROWS = with_flights(top_per_group_sql(["origin"], ["carrier"], missing="zero"))

TOPK_DISTINCT = with_flights(
    "SELECT 'global' AS scope, CAST(NULL AS VARCHAR) AS grp, airline_id AS item, "
    "total_arr_delay AS total, rank FROM ("
    + topk_sql("(SELECT airline_id, CAST(sum(arr_delay_min) AS BIGINT) AS total_arr_delay "
               "FROM flights WHERE airline_id IS NOT NULL AND airline_id <> '' "
               "AND arr_delay_min IS NOT NULL GROUP BY airline_id)",
               10, "total_arr_delay", item=["airline_id"], ties="distinct")
    + ") UNION ALL SELECT 'per_origin', origin, carrier, total_dep_delay, rank FROM ("
    + top_per_group_sql(["origin"], ["carrier"], ties="distinct") + ")")


def arrays_sql(ranked: str, group: Sequence[str], group_out: Sequence[str], item: str,
               names_out: str, values_out: str, extra: Sequence[str] = (),
               value: str = "total") -> str:
    """``topk.ranked_arrays`` in DuckDB: ordered lists per group."""
    sel = ", ".join([*extra, *[f"{g} AS {o}" for g, o in zip(group, group_out)]])
    keys = ", ".join([*extra, *group])
    return (f"SELECT {sel}, list({item} ORDER BY rank) AS {names_out}, "
            f"list({value} ORDER BY rank) AS {values_out} FROM ({ranked}) AS _a "
            f"GROUP BY {keys}")


PARALLEL_ARRAYS = with_flights(arrays_sql(
    top_per_group_sql(["origin"], ["carrier"]), ["origin"], ["airport"], "carrier",
    "top_carriers", "top_carriers_depdelay", value="total_dep_delay"))

KV_ROUNDTRIP = with_flights(
    "SELECT origin, carrier, total_dep_delay FROM ("
    + top_per_group_sql(["origin"], ["carrier"]) + ")")


def _leg_split_sql() -> str:
    leg1, leg2 = legs_sql()
    return with_flights(
        "SELECT 1 AS leg, src AS origin, mid AS dest, mid, start_date, dep1 AS dep_time, "
        "delay1 AS delay FROM leg1 UNION ALL SELECT 2, mid, dst, mid, start_date, dep2, "
        "delay2 FROM leg2", leg1, leg2)


LEG_SPLIT = _leg_split_sql()

# (stream job name) -> (group, item, group_out, names_out, values_out)
STREAM_JOBS = {
    "carriers_per_airport": (["origin"], "carrier", ["airport"],
                             "top_carriers", "top_carriers_depdelay"),
    "dests_per_airport": (["origin"], "dest", ["source_airport"],
                          "top_dst_airports", "top_dst_airports_depdelay"),
    "carriers_per_route": (["origin", "dest"], "carrier", ["source", "destination"],
                           "top_carriers", "top_carriers_depdelay"),
}


def ranking_sql(job: str, source: str, extra: Sequence[str] = ()) -> str:
    """Arrays of the k=10 ranking per (extra, group) with missing delay = 0."""
    group, item, group_out, names_out, values_out = STREAM_JOBS[job]
    keys = [*extra, *group, item]
    sums = (f"(SELECT {', '.join(keys)}, CAST(sum(coalesce(dep_delay_min, 0)) AS BIGINT) "
            f"AS total FROM {source} GROUP BY {', '.join(keys)})")
    ranked = topk_sql(sums, 10, "total", [*extra, *group], [item])
    return arrays_sql(ranked, group, group_out, item, names_out, values_out, extra=extra)


def latest_ranking_sql(job: str, source: str = "parsed") -> str:
    """Per key, the ranking of the last bucket (= micro-batch) holding it."""
    _, _, group_out, names_out, values_out = STREAM_JOBS[job]
    per_bucket = ranking_sql(job, source, extra=["bucket"])
    keys = ", ".join(group_out)
    return (f"SELECT {keys}, {names_out}, {values_out} FROM ({per_bucket}) AS _b "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY bucket DESC) = 1")


LATEST_PER_KEY = with_flights(latest_ranking_sql("carriers_per_airport", "flights"))
STREAM_CARRIERS_PER_AIRPORT = with_parsed(latest_ranking_sql("carriers_per_airport"))
STREAM_DESTS_PER_AIRPORT = with_parsed(latest_ranking_sql("dests_per_airport"))
STREAM_CARRIERS_PER_ROUTE = with_parsed(latest_ranking_sql("carriers_per_route"))
STREAM_RUNNING = with_parsed(ranking_sql("carriers_per_airport", "parsed"))
STREAM_WINDOW = with_parsed(
    "SELECT CAST(window_start AS TIMESTAMP) AS window_start, "
    "CAST(window_start + INTERVAL 1 DAY AS TIMESTAMP) AS window_end, airport, "
    "top_carriers, top_carriers_depdelay FROM ("
    + ranking_sql("carriers_per_airport",
                  "(SELECT *, CAST(flight_date AS TIMESTAMP) AS window_start FROM parsed "
                  "WHERE flight_date IS NOT NULL)", extra=["window_start"]) + ")")


#: Days of lateness of the ledger queries; a batch is a bucket.
LEDGER_DAYS = 1500
# Per bucket: the latest day of the buckets before it, less the lateness.
_LEDGER = f"""marks AS (
  SELECT bucket, max(latest) OVER (ORDER BY bucket ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL {LEDGER_DAYS} DAY AS mark, max(latest) OVER () - INTERVAL {LEDGER_DAYS} DAY AS last_mark
  FROM (SELECT bucket, max(flight_date) AS latest FROM parsed GROUP BY bucket)),
ledger AS (
  SELECT p.*, last_mark, CAST(flight_date AS TIMESTAMP) AS window_start,
    CAST(flight_date + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
    CASE WHEN flight_date IS NULL THEN 'undated' WHEN flight_date + INTERVAL 1 DAY <= mark THEN 'late' END AS reason
  FROM parsed p JOIN marks USING (bucket))"""
STREAM_LATE = with_parsed(
    f"SELECT {PARSED_COLS}, window_start, window_end, reason, CAST(bucket AS INTEGER) AS batch_id "
    "FROM ledger WHERE reason IS NOT NULL", _LEDGER)
STREAM_LEDGER = with_parsed(
    ranking_sql("carriers_per_airport", "(SELECT * FROM ledger WHERE reason IS NULL AND window_end <= last_mark)",
                extra=["window_start", "window_end"]), _LEDGER)


def stream_itinerary_lists_sql(k: int | None = 10, source: str = "parsed") -> str:
    leg1, leg2 = legs_sql(delay_col="dep_delay_min", noon_inclusive=True, source=source)
    if k is None:
        return with_parsed(_WHOLE_LISTS, leg1, leg2, _PAIRS)
    return with_parsed(
        f"SELECT start_date, src, mid, dst, CAST(count(*) AS BIGINT) AS n_pairs, "
        f"list({{'total': total_delay, 'dep1': dep1, 'dep2': dep2}} "
        f"ORDER BY total_delay, dep1, dep2) FILTER (WHERE _rn <= {k}) AS pairs "
        f"FROM (SELECT *, row_number() OVER (PARTITION BY start_date, src, mid, dst "
        f"ORDER BY total_delay, dep1, dep2, delay1) AS _rn FROM pairs) "
        f"GROUP BY start_date, src, mid, dst", leg1, leg2, _PAIRS)


def stream_itinerary_sql(k: int | None = 10) -> str:
    return " UNION ALL ".join(
        f"SELECT {b} AS batch_id, * FROM ("
        + stream_itinerary_lists_sql(k, f"(SELECT * FROM parsed WHERE bucket = {b})") + ")" for b in range(4))


INGESTED = with_parsed(
    f"SELECT {PARSED_COLS}, CAST(year(flight_date) AS INTEGER) AS year, "
    "CAST(month(flight_date) AS INTEGER) AS month FROM parsed")

STREAM_WINDOW_HOUR = with_parsed(
    "SELECT CAST(window_start AS TIMESTAMP) AS window_start, "
    "CAST(window_start + INTERVAL 1 HOUR AS TIMESTAMP) AS window_end, airport, "
    "top_carriers, top_carriers_depdelay FROM ("
    + ranking_sql("carriers_per_airport",
                  "(SELECT *, CAST(flight_date AS TIMESTAMP) "
                  "+ to_hours(coalesce(dep_time, 0) // 100) AS window_start FROM parsed "
                  "WHERE flight_date IS NOT NULL)", extra=["window_start"]) + ")")

# The faults of ``tables.faulty_lines`` and what parsing says about them.
FAULTY = """faulty AS (
  SELECT carrier, origin, dest, dep_delay_min, dep_time, year, airline_id,
    CASE WHEN s % 7 = 1 THEN 'abc' ELSE arr_delay_min END AS arr_delay_min,
    CASE WHEN s % 5 = 2 THEN 'x' ELSE day_of_week END AS day_of_week,
    CASE WHEN s % 11 = 3 THEN '2' ELSE month END AS month,
    CASE WHEN s % 11 = 3 THEN '30' ELSE day_of_month END AS day_of_month,
    CASE WHEN s % 13 = 4 THEN 'short' WHEN s % 17 = 5 THEN 'blank' ELSE 'whole' END AS kind,
    s % 7 = 1 AS bad_delay, s % 5 = 2 AS bad_week, s % 11 = 3 AS bad_day
  FROM (SELECT *, CAST(airline_id AS BIGINT) AS s FROM concise)
)"""

REJECTED_ROWS = "WITH " + ", ".join((CONCISE, FAULTY)) + """
SELECT CASE kind WHEN 'blank' THEN 'empty message' WHEN 'short' THEN 'too few fields'
    ELSE CASE WHEN bad_delay OR bad_week THEN 'bad number' ELSE 'invalid date' END END AS reject_reason,
  CASE kind
    WHEN 'blank' THEN 'carrier,origin,dest,dep_delay_min,arr_delay_min,dep_time,flight_date,day_of_week,airline_id'
    WHEN 'short' THEN 'dep_delay_min,arr_delay_min,dep_time,flight_date,day_of_week,airline_id'
    ELSE concat_ws(',', CASE WHEN bad_delay THEN 'arr_delay_min' END, CASE WHEN bad_day THEN 'flight_date' END,
      CASE WHEN bad_week THEN 'day_of_week' END) END AS bad_fields,
  CASE kind WHEN 'blank' THEN '  ' WHEN 'short' THEN carrier || ',' || origin || ',' || dest
    ELSE carrier || ',' || origin || ',' || dest || ',' || coalesce(dep_delay_min, '') || ','
      || coalesce(arr_delay_min, '') || ',' || coalesce(dep_time, '') || ',' || year || ',' || month || ','
      || day_of_month || ',' || day_of_week || ',' || airline_id END AS raw_line
FROM faulty WHERE kind <> 'whole' OR bad_delay OR bad_week OR bad_day"""

TOP_AIRPORTS_FAULTY = "WITH " + ", ".join((CONCISE, FAULTY)) + " " + topk_sql(
    "(SELECT airport, CAST(count(*) AS BIGINT) AS flights FROM "
    "(SELECT origin AS airport FROM faulty WHERE kind <> 'blank' "
    "UNION ALL SELECT dest FROM faulty WHERE kind <> 'blank') "
    "GROUP BY airport)", 10, "flights", item=["airport"], ascending=False)
