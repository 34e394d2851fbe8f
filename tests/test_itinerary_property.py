"""Itineraries on random flights vs a plain-Python model of the rules."""

from __future__ import annotations

import datetime as dt
import itertools
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerolap.operators.itinerary import (
    best_itineraries, itinerary_lists, itinerary_pair_summary, leg_candidates)

BASE = dt.date(2007, 12, 28)
flight = st.tuples(
    st.sampled_from(["A", "B", "C"]), st.sampled_from(["A", "B", "C"]),
    st.integers(0, 6),                       # day offset: crosses the year end
    st.sampled_from([0, 1159, 1200, 1201, 2359, 930, 1500]),
    st.integers(-5, 5))                      # delay


def model(rows, noon_inclusive):
    first, second = defaultdict(list), defaultdict(list)
    for o, d, off, t, delay in rows:
        day = BASE + dt.timedelta(days=off)
        if t < 1200:
            first[(d, day)].append((o, t, delay))
        if t > 1200 or (noon_inclusive and t == 1200):
            second[(o, day - dt.timedelta(days=2))].append((d, t, delay))
    pairs = defaultdict(list)
    for (mid, day), l1 in first.items():
        for (src, t1, d1), (dst, t2, d2) in itertools.product(l1, second.get((mid, day), [])):
            pairs[(day, src, mid, dst)].append((d1 + d2, t1, t2, d1))
    return pairs


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(flight, min_size=1, max_size=25), noon_inclusive=st.booleans())
def test_itineraries_match_model(spark, rows, noon_inclusive):
    df = spark.createDataFrame(
        [(o, d, BASE + dt.timedelta(days=off), t, delay) for o, d, off, t, delay in rows],
        "origin string, dest string, flight_date date, dep_time int, arr_delay_min int")
    legs = leg_candidates(df, noon_inclusive=noon_inclusive)
    pairs = model(rows, noon_inclusive)

    best = {(r.start_date, r.src, r.mid, r.dst): (r.total_delay, r.dep1, r.dep2)
            for r in best_itineraries(legs).collect()}
    assert best == {k: min(v)[:3] for k, v in pairs.items()}

    summ = {(r.start_date, r.src, r.mid, r.dst): (r.n_pairs, r.min_total, r.max_total,
                                                  r.sum_total)
            for r in itinerary_pair_summary(legs).collect()}
    assert summ == {k: (len(v), min(p[0] for p in v), max(p[0] for p in v),
                        sum(p[0] for p in v)) for k, v in pairs.items()}

    lists = {(r.start_date, r.src, r.mid, r.dst): (r.n_pairs, [tuple(p) for p in r.pairs])
             for r in itinerary_lists(legs, 2).collect()}
    assert lists == {k: (len(v), [p[:3] for p in sorted(v)[:2]]) for k, v in pairs.items()}
