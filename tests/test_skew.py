"""A hot key holding a large share of all rows: results stay exact.

The fixture is derived from the sf0.001 tables: every flight of bucket 0
arrives at one hub and every flight of bucket 1 leaves it, so about half of
all legs meet at a single airport (and the hub is the origin of a quarter of
all flights). Results are compared with plain-Python brute force.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

from conftest import SF_SMALL
from pyspark.sql import functions as F

from aerolap.operators.itinerary import best_itineraries, itinerary_lists, leg_candidates
from aerolap.plans import jobs
from aerolap.sources.tables import flight_view


def _hub_flights(spark):
    f = flight_view(spark, SF_SMALL)
    return f.select(
        "carrier",
        F.when(F.col("bucket") == 1, F.lit("HUB")).otherwise(F.col("origin")).alias("origin"),
        F.when(F.col("bucket") == 0, F.lit("HUB")).otherwise(F.col("dest")).alias("dest"),
        "dep_delay_min", "arr_delay_min", "dep_time", "flight_date", "day_of_week",
        "airline_id")


def test_hot_origin_ranking_exact(spark):
    f = _hub_flights(spark)
    rows = [r for r in f.collect() if r.origin and r.carrier and r.dep_delay_min is not None]
    totals = defaultdict(int)
    for r in rows:
        totals[(r.origin, r.carrier)] += r.dep_delay_min
    expect = {}
    for (o, c), v in sorted(totals.items(), key=lambda kv: (kv[0][0], kv[1], kv[0][1])):
        expect.setdefault(o, [])
        if len(expect[o]) < 10:
            expect[o].append((c, v))
    got = {}
    for r in jobs.top_carriers_per_airport(f).orderBy("origin", "rank").collect():
        got.setdefault(r.origin, []).append((r.carrier, r.total_dep_delay))
    assert got == expect
    hub_share = sum(1 for r in rows if r.origin == "HUB") / len(rows)
    assert hub_share > 0.2


def test_hot_hub_itineraries_exact(spark):
    legs = leg_candidates(_hub_flights(spark))
    first, second = defaultdict(list), defaultdict(list)
    for r in legs.collect():
        (first if r.leg == 1 else second)[(r.mid, r.start_date)].append(r)
    pairs = defaultdict(list)
    for key, l1 in first.items():
        for a, b in itertools.product(l1, second.get(key, [])):
            pairs[(a.start_date, a.other, a.mid, b.other)].append(
                (a.delay + b.delay, a.dep, b.dep, a.delay))
    assert any(k[2] == "HUB" for k in pairs)

    best = {(r.start_date, r.src, r.mid, r.dst): (r.total_delay, r.dep1, r.dep2)
            for r in best_itineraries(legs).collect()}
    assert best == {k: min(v)[:3] for k, v in pairs.items()}

    lists = {(r.start_date, r.src, r.mid, r.dst): (r.n_pairs, [tuple(p) for p in r.pairs])
             for r in itinerary_lists(legs, 3).collect()}
    assert lists == {k: (len(v), [p[:3] for p in sorted(v)[:3]]) for k, v in pairs.items()}
