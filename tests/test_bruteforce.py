"""Operators against plain-Python brute force on random small fixtures."""

import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.scalar import round_ratio_half_even
from tidemark.operators.baseline import centred_circular
from tidemark.operators.windows import horizon_change, rollmean

SETTINGS = settings(max_examples=20, deadline=None, derandomize=True, database=None,
                    suppress_health_check=list(HealthCheck))


def _round_half_even(fr: Fraction, scale: int) -> float:
    q = fr * 10 ** scale
    n, r = divmod(q.numerator, q.denominator)  # floor
    twice = 2 * r
    if twice > q.denominator or (twice == q.denominator and n % 2 == 1):
        n += 1
    return float(n) / 10 ** scale


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**15, 10**15), st.integers(-9 * 10**14, 9 * 10**14)), min_size=1, max_size=40))
def test_half_even_matches_exact_fractions(spark, pairs):
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r.v for r in df.select(round_ratio_half_even(F.col("n"), F.col("d"), 2, 100).alias("v")).collect()]
    want = [None if d == 0 else _round_half_even(Fraction(n * 100, d), 2) for n, d in pairs]
    assert got == want


@SETTINGS
@given(st.dictionaries(st.integers(0, 60), st.one_of(st.none(), st.integers(0, 1000)), min_size=1, max_size=40),
       st.sampled_from(["right", "left"]))
def test_rollmean_matches_brute_force(spark, points, align):
    rows = sorted(points.items())
    df = spark.createDataFrame(rows, "d int, x long")
    got = {r.d: r.m for r in df.select("d", rollmean("x", 7, "d", align=align).alias("m")).collect()}
    xs = [x for _, x in rows]
    for i, (d, _) in enumerate(rows):
        lo, hi = (i - 6, i + 1) if align == "right" else (i, i + 7)
        frame = xs[lo:hi] if lo >= 0 and hi <= len(xs) else None
        want = None if frame is None or any(v is None for v in frame) else sum(frame) / 7.0
        assert got[d] == want, (d, got[d], want)


@SETTINGS
@given(st.dictionaries(st.integers(1, 52), st.integers(0, 500), min_size=1, max_size=52))
def test_circular_baseline_matches_brute_force(spark, weeks):
    first_sat = dt.date(1997, 1, 4)
    df = spark.createDataFrame([(first_sat + dt.timedelta(days=7 * (w - 1)), v) for w, v in weeks.items()],
                               "week_end date, n long")
    got = {r.iso_week: r.base for r in centred_circular(df, 1997).collect()}
    want = {}
    for w in range(1, 53):
        nb = [(w - 2) % 52 + 1, w, w % 52 + 1]
        if any(x in weeks for x in nb):   # all three neighbours, or NULL
            want[w] = sum(weeks[x] for x in nb) / 3.0 if all(x in weeks for x in nb) else None
    if 52 in want and 1 in want:
        want[53] = (want[52] + want[1]) / 2.0 if want[52] is not None and want[1] is not None else None
    assert got == want


@SETTINGS
@given(st.dictionaries(st.integers(0, 80), st.integers(1, 900), min_size=1, max_size=60))
def test_horizon_change_matches_brute_force(spark, pts):
    base = dt.date(2020, 1, 4)
    rows = [("a", base + dt.timedelta(days=7 * k), v) for k, v in pts.items()]
    df = spark.createDataFrame(rows, "area string, week_end date, n long")
    hz = [("WoW", 7), ("MoM", 28), ("YoY", 364)]
    got = {r.change: r.chg for r in horizon_change(df, ["area"], "week_end", "n", hz).collect()}
    by_date = {d: v for _, d, v in rows}
    mx = max(by_date)
    for name, back in hz:
        new, old = by_date[mx], by_date.get(mx - dt.timedelta(days=back), by_date[mx])
        assert got[name] == _round_half_even(Fraction((new - old) * 100, old), 2)


def test_horizon_null_old_value_is_null(spark):
    rows = [("a", dt.date(2020, 1, 4), None), ("a", dt.date(2020, 1, 11), 5)]
    df = spark.createDataFrame(rows, "area string, week_end date, n long")
    got = {r.change: r.chg for r in horizon_change(df, ["area"], "week_end", "n", [("WoW", 7), ("MoM", 28)]).collect()}
    assert got == {"WoW": None, "MoM": 0.0}


def test_zero_base_rule(spark):
    from tidemark.functions.scalar import cap, ratio
    from tidemark.operators.indices import inverse_index_capped, ratio_index
    df = spark.createDataFrame([(5.0, 0.0), (0.0, 0.0), (0.0, 4.0), (-1.0, 0.0), (None, 0.0), (3.0, None)], "x double, b double")
    rows = df.select(cap(ratio_index(F.col("x"), F.col("b"))).alias("r"), inverse_index_capped(F.col("x"), F.col("b")).alias("c"),
                     ratio(F.col("x"), F.col("b")).alias("q")).collect()
    assert [r.r for r in rows] == [100.0, None, 0.0, float("-inf"), None, None]
    assert [r.c for r in rows][:3] == [0.0, None, 100.0]
    assert rows[0].q == float("inf") and rows[1].q is None


def test_week_of_nulls_sums_to_zero(spark):
    from tidemark.operators.series import daily_to_weekly
    df = spark.createDataFrame([(dt.date(2020, 1, 6), None), (dt.date(2020, 1, 7), None)], "d date, n long")
    assert daily_to_weekly(df, "d", [], ["n"]).first()["n"] == 0
