"""Lists of all pairs: nothing is cut from a trip with many of them."""

from __future__ import annotations

import itertools
import random

import duckdb
import pytest
from conftest import flights

import __spark_entry__ as E
from aerolap.operators.itinerary import itinerary_lists, leg_candidates


def trip_tables(folder):
    """Tables with one trip A -> B -> C of 4 x 5 flights, all in one bucket."""
    c = duckdb.connect()
    legs = [(24, 24, 24, "1998-03-01", n, n * 7 % 5) for n in range(1, 5)]
    legs += [(48, 2, 48, "1998-03-03", n, n * 11 % 7) for n in range(1, 6)]
    lines = ", ".join(f"({o}, {p}, {s}, {n}, {float(delay)}, {delay * 1000.0}, 0.01, DATE '{day}')" for o, p, s, day, n, delay in legs)
    for table, cols, rows in (
            ("nation", "n_nationkey, n_name", "(0, 'A'), (1, 'B'), (2, 'C')"),
            ("customer", "c_custkey, c_nationkey", "(1, 1), (2, 2)"),
            ("supplier", "s_suppkey, s_nationkey", "(24, 0), (48, 1)"),
            ("part", "p_partkey, p_brand", "(24, 'AA'), (2, 'BB')"),
            ("orders", "o_orderkey, o_custkey", "(24, 1), (48, 2)"),
            ("lineitem", "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_tax, l_shipdate", lines)):
        c.execute(f"COPY (SELECT * FROM (VALUES {rows}) t({cols})) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    first, second = ([(d, (p * 7 % 24) * 100 + (o * 11 + n) % 60) for o, p, _, _, n, d in part] for part in (legs[:4], legs[4:]))
    return sorted((a[0] + b[0], a[1], b[1]) for a, b in itertools.product(first, second))


@pytest.mark.parametrize("name", ["q_itinerary_lists", "stream_itinerary"])
def test_registered_lists_hold_every_pair(spark, tmp_dir, name):
    want = trip_tables(tmp_dir)
    (row,) = E.queries()[name](spark, tmp_dir).collect()
    assert (str(row.start_date), row.src, row.mid, row.dst, row.n_pairs) == ("1998-03-01", "A", "B", "C", 20)
    assert [tuple(p) for p in row.pairs] == want
    (row,) = E.queries()[{"q_itinerary_lists": "q_itinerary_k_best"}.get(name, "stream_itinerary_k_best")](spark, tmp_dir).collect()
    assert row.n_pairs == 20 and [tuple(p) for p in row.pairs] == want[:10]


def test_whole_lists_equal_all_pairs(spark):
    """Random flights, equal ones among them, against the product of their legs."""
    rnd = random.Random(4)
    legs1 = [(rnd.choice("XW"), "Y", rnd.randint(-3, 3), rnd.choice((900, 930, 1159))) for _ in range(40)]
    legs2 = [("Y", rnd.choice("ZX"), rnd.randint(-3, 3), rnd.choice((1201, 1500))) for _ in range(30)]
    lines = [f"AA,{s},{d},0,{delay},{dep:04d},2008,1,{day},1,1" for day, legs in ((5, legs1), (7, legs2)) for s, d, delay, dep in legs]
    got = {(r.src, r.mid, r.dst): (r.n_pairs, [tuple(p) for p in r.pairs])
           for r in itinerary_lists(leg_candidates(flights(spark, lines)), None).collect()}
    want = {}
    for (src, mid, d1, t1), (_, dst, d2, t2) in itertools.product(legs1, legs2):
        want.setdefault((src, mid, dst), []).append((d1 + d2, t1, t2))
    assert got == {k: (len(v), sorted(v)) for k, v in want.items()}


def test_whole_lists_shuffle_flights_only(spark):
    """No window, sort or exchange above the join of the two legs, and the legs
    come from one scan."""
    df = itinerary_lists(leg_candidates(flights(spark, ["AA,X,Y,0,1,0900,2008,1,5,6,1"])), None)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join Inner")]
    assert "Window" not in above and "Sort" not in above and "Aggregate" not in above
