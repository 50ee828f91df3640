"""Index queries: the six measure indices and their baseline pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.scalar import cap
from tidemark.operators import indices as ix
from tidemark.operators.baseline import centred_circular, join_baseline
from tidemark.operators.series import zero_fill_daily
from tidemark.operators.windows import rollmean
from tidemark.plans import feeds as fd
from tidemark.plans import sql as S
from tidemark.plans.registry import query

W = S.with_ctes
D = S.D


@query("ratio_index", W("SELECT * FROM home"))
def ratio_index(t):
    """Weekly orders / circular-centred base-year baseline * 100, capped."""
    return fd.home_sales(t)


@query("baseline_centred", W("SELECT iso_week, base FROM bw"))
def baseline_centred(t):
    """The baseline itself, 53 rows."""
    return centred_circular(fd.weekly_orders(t), t.base_year)


_BL = S.baseline_ctes("bl52", "wk", week53=False)
S.CTES.update(_BL)
S.CTES["bl_out"] = (
    f"SELECT wk.week_end, {S.isoweek('wk.week_end')} AS iso_week, wk.n, b.base, "
    f"{S.ratio('wk.n', 'b.base')} * {D(100)} AS index_original, "
    f"{S.cap(S.ratio('wk.n', 'b.base') + ' * ' + D(100))} AS index "
    f"FROM wk LEFT JOIN bl52 b ON b.iso_week = {S.isoweek('wk.week_end')} "
    f"WHERE wk.week_end >= DATE '{fd.SINCE}'")


@query("baseline_left", W("SELECT * FROM bl_out"))
def baseline_left(t):
    """Left join to a 52-week baseline (no week-53 rule): weeks 53 keep
    their row with a NULL baseline and NULL index (cap keeps NULL)."""
    wk = fd.weekly_orders(t)
    base = centred_circular(wk, t.base_year, week53_rule=False)
    s = join_baseline(wk, base, "left").where(F.col("week_end") >= F.lit(t.since))
    io = ix.ratio_index(F.col("n"), F.col("base"))
    return s.select("week_end", "iso_week", "n", "base", io.alias("index_original"), cap(io).alias("index"))


@query("baseline_inner", W(
    f"SELECT wk.week_end, b.iso_week, wk.n, b.base FROM wk JOIN bl52 b "
    f"ON b.iso_week = {S.isoweek('wk.week_end')} WHERE wk.week_end >= DATE '{fd.SINCE}'"))
def baseline_inner(t):
    """Inner join drops the weeks without a baseline (ISO week 53)."""
    wk = fd.weekly_orders(t)
    base = centred_circular(wk, t.base_year, week53_rule=False)
    return (join_baseline(wk, base, "inner").where(F.col("week_end") >= F.lit(t.since))
            .select("week_end", "iso_week", "n", "base"))


@query("cap_index", W("SELECT week_end, index FROM home"))
def cap_index(t):
    """The capped column only."""
    return fd.home_sales(t).select("week_end", "index")


@query("inverse_index", W("SELECT * FROM claims"))
def inverse_index(t):
    """D3: weekly returned lines, 100 * base / x via the reference's steps."""
    return fd.claims(t)


@query("seasonal_index", W("SELECT * FROM rentals"))
def seasonal_index(t):
    """Weekly shipped quantity against the monthly seasonal model."""
    return fd.rentals(t)


@query("seasonal_latest", W("SELECT rentals.* FROM rentals, aw WHERE rentals.week_end = aw.asof"))
def seasonal_latest(t):
    """The one new row of the weekly run - exact look-up of the
    analysis week in the seasonal feed."""
    return fd.rentals(t).where(F.col("week_end") == fd.asof_value(t))


S.CTES.update({
    "ev_d": ("SELECT CAST(ts AS DATE) AS d, CAST(count_if(event_type = 'error') AS BIGINT) AS n FROM events GROUP BY 1"),
    "ev_f": ("SELECT s.d, COALESCE(ev_d.n, 0) AS n FROM "
             "(SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM ev_d) s "
             "LEFT JOIN ev_d ON ev_d.d = s.d"),
    "ev_m": f"SELECT d, n, {S.rollmean('n', 'd')} AS rolling_seven FROM ev_f",
    "ev_i": (f"SELECT d, n, rolling_seven, "
             f"({D(1)} - log10(rolling_seven + {D(1)}) / {D(ix.LOG_SCALE)}) * {D(100)} AS index_original FROM ev_m"),
})


@query("log_index", W(f"SELECT d, n, rolling_seven, index_original, {S.cap('index_original')} AS index "
                      f"FROM ev_i WHERE {S.cap('index_original')} IS NOT NULL"))
def log_index(t):
    """D5 on events: daily `error` events, zero-filled, 7-row guard, log-damped."""
    ev = (fd.events_type_daily(t).groupBy("d")
          .agg(F.sum(F.when(F.col("event_type") == "error", F.col("n")).otherwise(F.lit(0))).alias("n")))
    s = zero_fill_daily(ev, "d", ["n"]).withColumn("rolling_seven", rollmean("n", fd.K, "d"))
    io = ix.log_index(F.col("rolling_seven"))
    return (s.select("d", "n", "rolling_seven", io.alias("index_original"), cap(io).alias("index"))
            .where(F.col("index").isNotNull()))


@query("hospital_index", W("SELECT * FROM hospital"))
def hospital_index(t):
    """D5 composite feed: daily urgent orders on a day spine."""
    return fd.hospital(t)


@query("shift_index", W("SELECT * FROM restaurants"))
def shift_index(t):
    """mean7 of daily YoY % change + 100, capped."""
    return fd.restaurants(t)


@query("comparable_index", W("SELECT * FROM subway"))
def comparable_index(t):
    """(1 + mean7(revenue / same-weekday base - 1)) * 100, capped."""
    return fd.subway(t)


@query("rollmean_complete", W("SELECT d, n, rolling_seven FROM hosp_m WHERE rolling_seven IS NOT NULL"))
def rollmean_complete(t):
    """The 7-row mean of the zero-filled urgent feed, non-null rows only."""
    daily = fd.orders_daily(t).select("d", F.col("n_urgent").alias("n"))
    s = zero_fill_daily(daily, "d", ["n"]).withColumn("rolling_seven", rollmean("n", fd.K, "d"))
    return s.where(F.col("rolling_seven").isNotNull())
