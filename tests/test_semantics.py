"""Unit tests for the semantic traps on tiny inline frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week, iso_year, last_saturday_on_or_before, week_ending_saturday
from tidemark.functions.scalar import cap, clean_name, pct_chg, round_ratio_half_even, slug, to_int_trunc
from tidemark.operators.baseline import centred_circular
from tidemark.operators.reshape import to_long, to_wide
from tidemark.operators.windows import diff, horizon_change, rollmean


def test_t1_rolling_frame_is_rows_not_days(spark):
    # holes in the dates do not shorten the window: 7 rows spanning 10 days
    days = [dt.date(2020, 1, d) for d in (1, 2, 3, 5, 6, 8, 10)]
    df = spark.createDataFrame([(d, i + 1) for i, d in enumerate(days)], "d date, x int")
    out = df.select("d", rollmean("x", 7, "d").alias("m")).orderBy("d").collect()
    assert [r.m for r in out[:6]] == [None] * 6
    assert out[6].m == 4.0


def test_t2_null_inside_frame_gives_null(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float(i)) for i in range(1, 10)], "d int, x double")
    out = {r.d: r.m for r in df.select("d", rollmean("x", 7, "d").alias("m")).collect()}
    assert out[7] is None and out[9] is None  # frame 3..9 contains the NULL
    assert out[6] is None                      # fewer than 7 rows


def test_rollmean_partitions_by_series_and_left_align(spark):
    df = spark.createDataFrame([(s, i, i * (1 if s == "a" else 10)) for s in "ab" for i in range(1, 9)],
                               "s string, d int, x int")
    out = {(r.s, r.d): (r.r, r.l) for r in df.select(
        "s", "d", rollmean("x", 7, "d", ["s"]).alias("r"), rollmean("x", 7, "d", ["s"], "left").alias("l")).collect()}
    assert out[("a", 1)] == (None, 4.0) and out[("a", 2)] == (None, 5.0)
    assert out[("a", 7)] == (4.0, None) and out[("a", 8)] == (5.0, None)
    assert out[("b", 7)][0] == 40.0 and out[("b", 1)][1] == 40.0


def test_t3_half_even_rounding_exact(spark):
    df = spark.createDataFrame([(1, 8), (3, 8), (5, 8), (-1, 8), (2675, 1000), (1, 3), (0, 5), (4, 0)],
                               "n long, d long")
    got = [r.v for r in df.select(round_ratio_half_even(F.col("n"), F.col("d"), 2, 1).alias("v")).collect()]
    assert got == [0.12, 0.38, 0.62, -0.12, 2.68, 0.33, 0.0, None]


def test_pct_chg_matches_reference_golden(spark):
    # published week-over-week change: 374 vs 283 -> 32.16
    df = spark.createDataFrame([(374, 283)], "new long, old long")
    assert df.select(pct_chg(F.col("new"), F.col("old"))).first()[0] == 32.16


def test_t4_cap_keeps_null_and_t15_nan(spark):
    df = spark.createDataFrame([(150.0,), (99.5,), (None,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(cap(F.col("x"))).collect()] == [100.0, 99.5, None, None]


def test_t5_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 2)], "k string, v int")
    out = dict(df.groupBy("k").agg(F.coalesce(F.sum("v"), F.lit(0)).alias("s")).collect())
    assert out == {"a": 0, "b": 2}


def test_t6_division_by_zero_is_infinite_not_error(spark):
    from tidemark.operators.indices import inverse_index, inverse_index_capped
    df = spark.createDataFrame([(0, 10.0), (5, 10.0)], "x long, b double")
    r = df.select(inverse_index(F.col("x"), F.col("b")).alias("o"),
                  inverse_index_capped(F.col("x"), F.col("b")).alias("c")).collect()
    assert r[0].o == float("inf") and r[0].c == 100.0  # Inf in R, capped to 100
    assert r[1].o == 200.0 and r[1].c == 100.0


def test_t7_iso_week_53_and_week_ending(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2022, 12, 3),), (dt.date(2022, 12, 4),)], "d date")
    r = df.select(iso_week(F.col("d")).alias("w"), iso_year(F.col("d")).alias("y"),
                  week_ending_saturday(F.col("d")).alias("we"),
                  last_saturday_on_or_before(F.col("d")).alias("ls")).collect()
    assert (r[0].w, r[0].y) == (53, 2020)
    assert r[1].we == dt.date(2022, 12, 3) and r[1].ls == dt.date(2022, 12, 3)
    assert r[2].we == dt.date(2022, 12, 10) and r[2].ls == dt.date(2022, 12, 3)


def test_w6_baseline_circular_centred_with_week53(spark):
    # one Saturday per ISO week of 1997, value = week number * 10
    sats = [dt.date(1997, 1, 4) + dt.timedelta(days=7 * i) for i in range(52)]
    df = spark.createDataFrame([(s, (i + 1) * 10) for i, s in enumerate(sats)], "week_end date, n long")
    b = {r.iso_week: r.base for r in centred_circular(df, 1997).collect()}
    assert len(b) == 53
    assert b[2] == (10 + 20 + 30) / 3
    assert b[1] == (520 + 10 + 20) / 3       # wraps to the last week
    assert b[52] == (510 + 520 + 10) / 3     # wraps to week 1
    assert b[53] == (b[52] + b[1]) / 2


def test_t10_missing_horizon_compares_with_itself(spark):
    df = spark.createDataFrame([("a", dt.date(2020, 1, 25), 120), ("a", dt.date(2020, 1, 18), 100)],
                               "area string, week_end date, n long")
    out = {r.change: r.chg for r in horizon_change(df, ["area"], "week_end", "n", [("WoW", 7), ("MoM", 28)]).collect()}
    assert out == {"WoW": 20.0, "MoM": 0.0}


def test_t13_pivot_missing_is_null_and_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([("m1", "a", 1), ("m1", "b", 2), ("m2", "a", 3)], "m string, k string, v long")
    wide = to_wide(df, ["m"], "k", "v", ["a", "b"])
    rows = {r.m: (r.a, r.b) for r in wide.collect()}
    assert rows == {"m1": (1, 2), "m2": (3, None)}
    back = to_long(wide, ["m"], "k", "v").collect()
    assert len(back) == 4 and sum(r.v is None for r in back) == 1


def test_t9_asc_nulls_last(spark):
    df = spark.createDataFrame([(None,), (2.0,), (1.0,)], "x double")
    assert [r.x for r in df.orderBy(F.col("x").asc_nulls_last()).collect()] == [1.0, 2.0, None]


def test_diff_first_row_null(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.5)], "d int, x double")
    assert [r[0] for r in df.select(diff("x", "d")).orderBy("d").collect()] == [None, 2.5]


def test_text_casts(spark):
    df = spark.createDataFrame([("12.7",), ("-3.9",), ("junk",), (None,)], "s string")
    assert [r[0] for r in df.select(to_int_trunc(F.col("s"))).collect()] == [12, -3, None, None]


def test_names():
    assert clean_name("Number of Pending Sales") == "number_of_pending_sales"
    assert clean_name("4-NOT SPECIFIED") == "x4_not_specified"
    assert clean_name("Community & Social Service\n") == "community_social_service"


def test_slug(spark):
    df = spark.createDataFrame([("Monthly IC by  Industry",)], "s string")
    assert df.select(slug(F.col("s"))).first()[0] == "monthly_ic_by_industry"


def test_t8_window_before_cut(spark):
    # the mean on the first kept day still sees the rows before the cut
    df = spark.createDataFrame([(d, d) for d in range(1, 11)], "d int, x long")
    kept = df.select("d", rollmean("x", 7, "d").alias("m")).where(F.col("d") >= 7)
    assert {r.d: r.m for r in kept.collect()}[7] == 4.0


def test_append_newer_with_empty_and_existing_history(spark):
    from tidemark.operators.composite import append_newer
    new = spark.createDataFrame([(dt.date(2020, 1, d), float(d)) for d in (4, 11, 18)], "date date, v double")
    empty = new.where(F.lit(False))
    assert append_newer(empty, new, "date").count() == 3
    hist = new.where(F.col("date") <= dt.date(2020, 1, 4)).withColumn("old", F.lit(1))
    out = append_newer(hist, new, "date", F.lit(dt.date(2020, 1, 11)))
    rows = sorted((r.date.day, r.old) for r in out.collect())
    assert rows == [(4, 1), (11, None)]


def test_wide_keeps_null_and_na_keys_apart(spark):
    from tidemark.operators.reshape import to_wide
    long = spark.createDataFrame([(1, None, 3), (1, "NA", 5), (1, "na", 7), (2, "_null", 9)], "id int, k string, v int")
    got = {r.id: r.asDict() for r in to_wide(long, ["id"], "k", "v").collect()}
    assert got == {1: {"id": 1, "_null": 3, "na": 5, "na_2": 7, "null": None},
                   2: {"id": 2, "_null": None, "na": None, "na_2": None, "null": 9}}
    assert to_wide(long, ["id"], "k", "v", prefix="s_", suffix="_x").columns[1] == "s__null_x"
    with pytest.raises(ValueError, match="more than 3"):
        to_wide(long, ["id"], "k", "v", max_columns=3)
