"""Two-leg itineraries X -> Y -> Z with a two-day stop at Y (JN-1..3).

A first leg X->Y departs before noon on day d; a second leg Y->Z departs
after noon on day d+2. A pair joins on (Y, d): the second leg's date is moved
back by ``gap_days`` so both legs carry the trip's start date.

No join here is over flight pairs. The pairs of one (X, Y, Z, d) are
the product of the X->Y morning flights and the Y->Z afternoon flights of
that trip, so:

* the **best** pair (the reference's stated goal) is the best first leg plus
  the best second leg: take the minimum of each leg per (route, day) first,
  then join one row per leg key (``best_itineraries``);
* the **k best** pairs only involve each leg's k best flights (any pair using
  a worse first leg is beaten by k pairs with the same second leg), so the
  join sees one row with at most k flights per leg key, and a trip's pairs are
  made and cut inside its own row (``k_best_itineraries``);
* the **whole lists** are the output that grows with the pairs, so all are
  made, but only there: one row with all its flights per leg key meets the
  other leg, and a trip's list is made inside its row (``itinerary_lists``
  without a ``k``);
* **all pairs** are summarised exactly from per-leg aggregates: number of
  pairs n1*n2, min and max total, sum of totals n2*S1 + n1*S2
  (``itinerary_pair_summary``).

Every join input is one row per leg route and day, so a hub that
holds a third of all flights sends only its distinct routes to the join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolap.functions.parse import dep_label, format_day, pack_min_key, unpack_hi, unpack_lo
from aerolap.operators.clean import require, time_of_day

LEG1_KEY = ["src", "mid", "start_date"]
LEG2_KEY = ["mid", "dst", "start_date"]
TRIP_KEY = ["start_date", "src", "mid", "dst"]
# Unified leg key: ``other`` is X for a first leg and Z for a second leg.
LEG_KEY = ["leg", "other", "mid", "start_date"]


def leg_candidates(flights: DataFrame, delay_col: str = "arr_delay_min",
                   noon: int = 1200, noon_inclusive: bool = False,
                   gap_days: int = 2, year: int | None = None) -> DataFrame:
    """PRJ-10, FLT-3/4/5, FN-4: both legs in one projection of one scan.

    Columns ``leg`` (1 = morning X->Y, 2 = afternoon Y->Z), ``other`` (X or
    Z), ``mid`` (Y), ``start_date`` (the first leg's day; a second leg's
    date minus ``gap_days``), ``dep``, ``delay``. ``delay_col`` is the
    measure (arrival delay in the batch job, departure delay in the stream
    job); rows without it, a departure time, a date or an airport are
    dropped. ``year`` keeps trips starting in that year.
    """
    if year is not None:
        # both legs of a trip that starts in ``year``: a plain date range on
        # the scan, and on the folder column of ingested flights
        last = dt.date(year, 12, 31) + dt.timedelta(days=gap_days)
        flights = flights.filter(F.col("flight_date").between(
            F.lit(dt.date(year, 1, 1)), F.lit(last)))
        if "year" in flights.columns:
            flights = flights.filter(F.col("year").between(year, last.year))
    base = require(flights, ["origin", "dest", "dep_time", "flight_date", delay_col])
    am = time_of_day("dep_time", noon, "morning")
    pm = time_of_day("dep_time", noon, "afternoon", noon_inclusive)
    legs = base.filter(am | pm).select(
        F.when(am, F.lit(1)).otherwise(F.lit(2)).alias("leg"),
        F.when(am, F.col("origin")).otherwise(F.col("dest")).alias("other"),
        F.when(am, F.col("dest")).otherwise(F.col("origin")).alias("mid"),
        F.when(am, F.col("flight_date"))
        .otherwise(F.date_sub(F.col("flight_date"), gap_days)).alias("start_date"),
        F.col("dep_time").alias("dep"), F.col(delay_col).alias("delay"))
    if year is not None:
        legs = legs.filter(F.year("start_date") == year)
    return legs


def _as_first(df: DataFrame) -> DataFrame:
    return df.filter(F.col("leg") == 1).withColumnRenamed("other", "src").drop("leg")


def _as_second(df: DataFrame) -> DataFrame:
    return df.filter(F.col("leg") == 2).withColumnRenamed("other", "dst").drop("leg")


def split_legs(flights: DataFrame, **kw) -> tuple[DataFrame, DataFrame]:
    """The two legs as separate frames: (src, mid, start_date, dep1, delay1)
    and (mid, dst, start_date, dep2, delay2)."""
    legs = leg_candidates(flights, **kw)
    leg1 = _as_first(legs).select(*LEG1_KEY, F.col("dep").alias("dep1"),
                                  F.col("delay").alias("delay1"))
    leg2 = _as_second(legs).select(*LEG2_KEY, F.col("dep").alias("dep2"),
                                   F.col("delay").alias("delay2"))
    return leg1, leg2


def _fence(df: DataFrame) -> DataFrame:
    """Pass rows through ``inline(array(struct(...)))`` (a Generate node).

    Filters above it cannot be pushed below it. Without it, Catalyst pushes
    the ``leg = 1`` / ``leg = 2`` filters of the two join sides down to the
    scan, the two sides stop being the same plan, and the flights are read
    and joined twice instead of once with a reused exchange.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))


def _pair_up(per_leg: DataFrame, cols1: dict, cols2: dict) -> DataFrame:
    """Join first-leg rows with second-leg rows of the same (Y, start day).

    Both sides are filters of one frame that holds a fence, so Spark computes
    (and shuffles) what lies below the fence once for both sides.
    """
    a = _as_first(per_leg).select(*LEG1_KEY, *[F.col(c).alias(n) for c, n in cols1.items()])
    b = _as_second(per_leg).select(*LEG2_KEY, *[F.col(c).alias(n) for c, n in cols2.items()])
    return a.join(b, ["mid", "start_date"])


def best_itineraries(legs: DataFrame) -> DataFrame:
    """JN-3: the best pair per (start_date, X, Y, Z).

    Best = least total delay; among equal delays the earlier departure.
    Each leg is reduced to its best flight per (route, day) with a packed
    BIGINT minimum (HashAggregate with a partial step before the shuffle),
    then one row per leg key meets the other leg's rows.
    """
    return pair_leg_minima(leg_minima(legs))


def leg_minima(legs: DataFrame) -> DataFrame:
    """Best flight per (leg, route, day) as one packed BIGINT ``_b``."""
    return legs.groupBy(*LEG_KEY).agg(F.min(pack_min_key("delay", "dep")).alias("_b"))


def pair_leg_minima(best: DataFrame) -> DataFrame:
    """Join the per-leg minima of both legs into best itineraries."""
    j = _pair_up(_fence(best), {"_b": "_b1"}, {"_b": "_b2"})
    d1, d2 = unpack_hi("_b1"), unpack_hi("_b2")
    return j.select(
        "start_date", "src", "mid", "dst",
        unpack_lo("_b1").alias("dep1"), unpack_lo("_b2").alias("dep2"),
        d1.alias("delay1"), d2.alias("delay2"),
        (d1.cast("long") + d2).alias("total_delay"))


def itinerary_pair_summary(legs: DataFrame) -> DataFrame:
    """Exact statistics over *all* pairs of each trip, without making pairs:
    n_pairs = n1*n2, min/max total = sums of leg minima/maxima, sum of
    totals = n2*S1 + n1*S2."""
    stats = legs.groupBy(*LEG_KEY).agg(
        F.count(F.lit(1)).alias("n"), F.min("delay").alias("lo"),
        F.max("delay").alias("hi"), F.sum("delay").alias("s"))
    j = _pair_up(_fence(stats), {"n": "n1", "lo": "min1", "hi": "max1", "s": "sum1"},
                 {"n": "n2", "lo": "min2", "hi": "max2", "s": "sum2"})
    return j.select(
        *TRIP_KEY,
        (F.col("n1") * F.col("n2")).alias("n_pairs"),
        (F.col("min1").cast("long") + F.col("min2")).alias("min_total"),
        (F.col("max1").cast("long") + F.col("max2")).alias("max_total"),
        (F.col("n2") * F.col("sum1") + F.col("n1") * F.col("sum2")).alias("sum_total"))


def counted_legs(legs: DataFrame) -> DataFrame:
    """Equal flights of a leg (key, delay, departure) with their number ``c``."""
    return legs.groupBy(*LEG_KEY, "delay", "dep").agg(F.count(F.lit(1)).alias("c"))


def _k_best_legs(counted: DataFrame, k: int) -> DataFrame:
    """Per leg key: the sorted list ``best`` of its k best flights (delay, dep)
    and the number ``n`` of all its flights.

    Equal flights (leg key, delay, departure) are counted first, with a
    partial count before the shuffle. That exchange hashes on six real values,
    so a hot leg key is spread, a recomputed task sends its rows to the same
    place, and AQE may resize it. A flight that stands for ``c`` equal ones
    is in the list as often as the k best still have room for. The fence lies
    above that count: each side of the join ranks its own leg only.
    """
    key = Window.partitionBy(*LEG_KEY)
    before = (F.sum("c").over(key.orderBy("delay", "dep").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c"))
    top = (_fence(counted).select("*", F.sum("c").over(key).alias("n"), before.alias("_before"))
           .filter(F.col("_before") < k)
           .withColumn("_times", F.least(F.col("c"), F.lit(k) - F.col("_before")).cast("int")))
    best = F.sort_array(F.collect_list(F.struct("delay", "dep", "_times")))
    return top.groupBy(*LEG_KEY).agg(F.max("n").alias("n"), best.alias("_best")).select(
        *LEG_KEY, "n", F.flatten(F.transform("_best", lambda x: F.array_repeat(
            F.struct(x["delay"].alias("delay"), x["dep"].alias("dep")), x["_times"]))).alias("best"))


def _k_best_pairs(counted: DataFrame, k: int) -> DataFrame:
    """One row per trip: ``n_pairs`` and ``_pairs``, its k best pairs in order of
    (total, dep1, dep2, delay1).

    One row per leg key meets the other leg's rows, and a trip's pairs are
    made and sorted inside its row, so no pair is shuffled or spilled. Pair
    (i, j) of the two sorted lists has i * j - 1 pairs before it that are no
    worse, so only those with i * j <= k are made (27 for k = 10).
    """
    j = _pair_up(_k_best_legs(counted, k), {"best": "best1", "n": "n1"}, {"best": "best2", "n": "n2"})
    made = F.flatten(F.transform("best1", lambda a, i: F.transform(
        F.slice("best2", F.lit(1), F.floor(F.lit(k) / (i + 1)).cast("int")),
        lambda b: F.struct((a["delay"].cast("long") + b["delay"]).alias("total"), a["dep"].alias("dep1"),
                           b["dep"].alias("dep2"), a["delay"].alias("delay1"), b["delay"].alias("delay2")))))
    return j.select(*TRIP_KEY, (F.col("n1") * F.col("n2")).alias("n_pairs"),
                    F.slice(F.sort_array(made), 1, k).alias("_pairs"))


def k_best_itineraries(legs: DataFrame, k: int) -> DataFrame:
    """The k best pairs per trip, ranked by (total, dep1, dep2), exact.

    Each leg keeps its k best flights per (route, day). Any pair using a first
    leg outside its k best is beaten or tied by k pairs with the same second
    leg (ties are identical output rows), so the result is the exact k-best
    multiset of all pairs. Also carries n_pairs.
    """
    return (_k_best_pairs(counted_legs(legs), k)
            .select(*TRIP_KEY, "n_pairs", F.posexplode("_pairs").alias("_at", "_p"))
            .select(*TRIP_KEY, "_p.dep1", "_p.dep2", "_p.delay1", "_p.delay2", F.col("_p.total").alias("total_delay"),
                    (F.col("_at") + 1).alias("rank"), "n_pairs"))


def itinerary_lists(legs: DataFrame, k: int | None) -> DataFrame:
    """AGG-6: per trip, its pairs as a sorted ``ARRAY<STRUCT<total, dep1, dep2>>``
    (the k best; all of them if ``k`` is None) plus the exact number of all pairs."""
    return _whole_lists(legs) if k is None else lists_of_counted(counted_legs(legs), k)


def _whole_lists(legs: DataFrame) -> DataFrame:
    """Every pair of every trip. A leg key's flights are collected into one row
    (partly before the shuffle), and a trip's list is made and sorted inside its
    row, so no pair is shuffled or spilled: a task holds one trip's list. That
    list is one value, so a row's limit of 2 GB (some 50 million pairs) holds."""
    per_leg = legs.groupBy(*LEG_KEY).agg(F.collect_list(F.struct("delay", "dep")).alias("flights"))
    j = _pair_up(_fence(per_leg), {"flights": "flights1"}, {"flights": "flights2"})
    made = F.flatten(F.transform("flights1", lambda a: F.transform("flights2", lambda b: F.struct(
        (a["delay"].cast("long") + b["delay"]).alias("total"), a["dep"].alias("dep1"), b["dep"].alias("dep2")))))
    return j.select(*TRIP_KEY, (F.size("flights1").cast("long") * F.size("flights2")).alias("n_pairs"),
                    F.sort_array(made).alias("pairs"))


def lists_of_counted(counted: DataFrame, k: int) -> DataFrame:
    """``itinerary_lists`` of legs that are counted already (``counted_legs``)."""
    pairs = F.transform("_pairs", lambda p: F.struct(p["total"].alias("total"), p["dep1"].alias("dep1"),
                                                     p["dep2"].alias("dep2")))
    return _k_best_pairs(counted, k).select(*TRIP_KEY, "n_pairs", pairs.alias("pairs"))


def itinerary_labels(best: DataFrame) -> DataFrame:
    """PRJ-11/12, FN-5: the reference's text key ``date,X@HHMM,Y@HHMM,Z``."""
    return best.select(
        format_day("start_date").alias("day"),
        dep_label("src", "dep1").alias("leg1"),
        dep_label("mid", "dep2").alias("leg2"),
        F.col("dst"),
        F.concat_ws(",", format_day("start_date"), dep_label("src", "dep1"),
                    dep_label("mid", "dep2"), F.col("dst")).alias("path"),
        F.col("total_delay"))
