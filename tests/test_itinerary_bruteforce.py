"""Itineraries against brute-force enumeration of all pairs (small fixture)."""

from __future__ import annotations

import itertools
from collections import defaultdict

from conftest import SF_SMALL

from aerolap.operators.itinerary import (
    best_itineraries, itinerary_lists, itinerary_pair_summary, leg_candidates)
from aerolap.sources.tables import flight_view


def _all_pairs(legs_rows):
    first = defaultdict(list)
    second = defaultdict(list)
    for r in legs_rows:
        (first if r.leg == 1 else second)[(r.mid, r.start_date)].append(r)
    pairs = defaultdict(list)
    for key, l1 in first.items():
        for a, b in itertools.product(l1, second.get(key, [])):
            pairs[(a.start_date, a.other, a.mid, b.other)].append(
                (a.delay + b.delay, a.dep, b.dep, a.delay))
    return pairs


def test_best_summary_lists_equal_brute_force(spark):
    legs = leg_candidates(flight_view(spark, SF_SMALL))
    pairs = _all_pairs(legs.collect())
    assert pairs, "fixture has itineraries"

    best = {(r.start_date, r.src, r.mid, r.dst): (r.total_delay, r.dep1, r.dep2)
            for r in best_itineraries(legs).collect()}
    assert best == {k: min(v)[:3] for k, v in pairs.items()}

    summ = {(r.start_date, r.src, r.mid, r.dst): (r.n_pairs, r.min_total, r.max_total,
                                                  r.sum_total)
            for r in itinerary_pair_summary(legs).collect()}
    assert summ == {k: (len(v), min(p[0] for p in v), max(p[0] for p in v),
                        sum(p[0] for p in v)) for k, v in pairs.items()}

    k = 2
    lists = {(r.start_date, r.src, r.mid, r.dst): (r.n_pairs, [tuple(p) for p in r.pairs])
             for r in itinerary_lists(legs, k).collect()}
    expect = {key: (len(v), [p[:3] for p in sorted(v)[:k]]) for key, v in pairs.items()}
    assert lists == expect
