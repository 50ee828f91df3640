"""Properties of whole query results at sf0.01."""

import datetime as dt
import math

from paths import SF001, SF01

import __spark_entry__ as E

Q = E.queries()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "hosp_index", "claims_index", "home_sales_index", "rental_index",
                          "subway_index", "restaurant_index", "composite_index"]
    assert df.count() > 0


def test_capped_indices_at_most_100(spark):
    for name in ("ratio_index", "inverse_index", "seasonal_index", "hospital_index", "shift_index",
                 "comparable_index"):
        df = Q[name](spark, SF01)
        mx = df.agg({"index": "max"}).first()[0]
        assert mx is None or mx <= 100.0, name


def test_composite_is_sum_of_scores_and_bounded(spark):
    for r in Q["composite_total"](spark, SF01).collect():
        parts = [r.hosp_index, r.claims_index, r.home_sales_index, r.rental_index, r.subway_index,
                 r.restaurant_index]
        assert all(p <= 100 / 6 + 1e-12 for p in parts)
        assert math.isclose(r.composite_index, sum(parts), rel_tol=1e-12)


def test_shares_sum_to_about_100(spark):
    for r in Q["share_wide"](spark, SF01).collect():
        vals = [v for k, v in r.asDict().items() if k != "month" and v is not None]
        assert 99.9 <= sum(vals) <= 100.1


def test_wow_composite_is_mean_of_differences(spark):
    rows = {r.measure: r.change for r in Q["wow_report"](spark, SF01).collect()}
    assert len(rows) == 7
    six = [v for k, v in rows.items() if k != "composite_index"]
    assert math.isclose(rows["composite_index"], sum(six) / 6, rel_tol=1e-9, abs_tol=1e-9)


def test_append_is_idempotent(spark):
    from tidemark.operators.composite import append_newer
    ov = Q["overview"](spark, SF001)
    again = append_newer(ov, ov, "date")
    assert again.count() == ov.count()


def test_overview_equals_composite_scores(spark):
    a = Q["overview"](spark, SF01)
    b = Q["composite_total"](spark, SF01).drop("composite_index")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_register_views_for_sql(spark):
    from tidemark.plans.registry import register_views
    names = register_views(spark, SF01, ["composite_total", "wow_report"], prefix="tm_")
    assert names == ["tm_composite_total", "tm_wow_report"]
    n = spark.sql("SELECT count(*) FROM tm_composite_total WHERE composite_index <= 100").first()[0]
    assert n == Q["composite_total"](spark, SF01).count()
    assert spark.sql("SELECT count(*) FROM tm_wow_report").first()[0] == 7


def test_t12_only_the_six_feeds_are_capped(spark):
    capped = Q["ratio_index"](spark, SF01).agg({"index": "max"}).first()[0]
    uncapped = Q["wide_area_index"](spark, SF01).agg({"all_index": "max"}).first()[0]
    assert capped <= 100.0 < uncapped


def test_wow_report_agrees_with_composite_change(spark):
    wow = {r.measure: r.change for r in Q["wow_report"](spark, SF01).collect()}
    week = Q["wow_report"](spark, SF01).first().analysis_week
    ch = {r.date: r.change for r in Q["composite_change"](spark, SF01).collect()}
    assert math.isclose(wow["composite_index"], ch[week], rel_tol=1e-12, abs_tol=1e-12)


def test_horizon_wow_follows_from_weekly_counts(spark):
    from fractions import Fraction
    from tidemark.plans import feeds as fd
    from tidemark.sources.tables import Tables
    wk = {(r.area, r.week_end): r.n for r in fd.segment_weekly(Tables(spark, SF01), with_all=True).collect()}
    for r in Q["horizon_change"](spark, SF01).where("change = 'WoW'").collect():
        mx = max(d for a, d in wk if a == r.area)
        new, old = wk[(r.area, mx)], wk.get((r.area, mx - dt.timedelta(days=7)))
        old = new if old is None else old
        assert abs(r.chg - float(Fraction((new - old) * 100, old))) <= 0.005 + 1e-12
