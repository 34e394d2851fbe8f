"""Plan assertions: the physical shapes the design relies on."""

from __future__ import annotations

from conftest import SF_SMALL

from aerolap.operators.itinerary import best_itineraries, itinerary_lists, leg_candidates
from aerolap.plans import jobs
from aerolap.sources.tables import flight_view


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_global_topk_is_take_ordered(spark):
    p = _plan(jobs.top_airlines(flight_view(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in p


def test_group_topk_limits_before_shuffle(spark):
    p = _plan(jobs.top_carriers_per_route(flight_view(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p
    assert "HashAggregate" in p


def test_itineraries_have_no_pair_explosion_operators(spark):
    legs = leg_candidates(flight_view(spark, SF_SMALL))
    for df in (best_itineraries(legs), itinerary_lists(legs, 10)):
        p = _plan(df)
        assert "CartesianProduct" not in p
        assert "BroadcastNestedLoopJoin" not in p


def test_best_itinerary_aggregates_before_join(spark):
    legs = leg_candidates(flight_view(spark, SF_SMALL))
    p = _plan(best_itineraries(legs))
    # partial aggregation happens map-side, below the join
    assert p.index("Join") < p.rindex("HashAggregate")


def test_scan_prunes_columns_and_pushes_filters(spark):
    f = flight_view(spark, SF_SMALL)
    p = _plan(jobs.top_airlines(f))
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_shipdate" not in scan  # not needed for airline totals
    assert "PushedFilters" in scan


def test_parser_runs_once_per_line_under_filters(spark):
    from aerolap.sources.csv import accepted, parse_concise

    lines = spark.createDataFrame([("AA,ORD,LAX,1,2,0800,2008,1,5,6,1",)], "value string")
    plan = accepted(parse_concise(lines))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1


def _final_plan(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_itineraries_scan_flights_once(spark):
    legs = leg_candidates(flight_view(spark, SF_SMALL))
    for df in (best_itineraries(legs), itinerary_lists(legs, 3)):
        p = _final_plan(df)
        scans = [ln for ln in p.splitlines() if "FileScan parquet" in ln and "l_orderkey" in ln]
        assert len(scans) == 1, p
        assert "ReusedExchange" in p


def test_without_broadcast_falls_back_to_sort_merge(spark):
    """Above the size check every join is a shuffled sort-merge join, same rows."""
    f = flight_view(spark, SF_SMALL)
    expect = sorted(tuple(r) for r in jobs.top_carriers_per_route(f).collect())
    keys = ["spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        df = jobs.top_carriers_per_route(flight_view(spark, SF_SMALL))
        p = _final_plan(df)
        assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
        assert sorted(tuple(r) for r in df.collect()) == expect
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_k_best_shuffles_no_raw_row_and_fixes_no_width(spark):
    from aerolap.operators.itinerary import itinerary_lists, leg_candidates
    from aerolap.sources.tables import flight_view
    from conftest import SF_SMALL

    df = itinerary_lists(leg_candidates(flight_view(spark, SF_SMALL)), 10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY" not in plan and "monotonically" not in plan
    assert "partial_count" in plan


def test_flight_view_without_broadcast_shuffles_lineitem_three_times(spark):
    from aerolap.sources.tables import flight_view
    from conftest import SF_SMALL

    want = sorted(map(tuple, flight_view(spark, SF_SMALL).collect()), key=repr)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = flight_view(spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        got = sorted(map(tuple, df.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
    assert got == want
    lines = plan.splitlines()
    shuffles = 0
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            below = []
            for x in lines[n + 1:]:
                if len(x) - len(x.lstrip(" :+-")) <= depth:
                    break
                below.append(x)
            shuffles += any("FileScan parquet [l_orderkey" in x for x in below)
    assert shuffles == 3


def test_no_pair_is_sorted_or_shuffled(spark):
    """A trip's pairs are made inside its row: no window, sort or exchange above
    the join of the two legs."""
    from aerolap.operators.itinerary import k_best_itineraries

    legs = leg_candidates(flight_view(spark, SF_SMALL))
    for df in (itinerary_lists(legs, 10), k_best_itineraries(legs, 10)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        above = plan[:plan.index("Join Inner")]
        assert "Window" not in above and "Sort" not in above and "Aggregate" not in above


def test_parsing_is_compiled_not_interpreted(spark):
    """Generators are evaluated row by row by an interpreter: the parse barriers
    hold column references only."""
    from aerolap.sources.csv import fields_by_header, parse_concise, typed_from_fields
    from aerolap.schema import RAW_HEADER_NAMES

    lines = spark.createDataFrame([("AA,ORD,LAX,1,2,0800,2008,1,5,6,1", "")], "value string, header string")
    for df in (parse_concise(lines), typed_from_fields(fields_by_header(lines, [",".join(RAW_HEADER_NAMES)]))):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        barriers = [line for line in plan.splitlines() if "Generate inline" in line]
        assert barriers and not any("cast(" in b or "from_csv" in b or "filter(" in b for b in barriers)
