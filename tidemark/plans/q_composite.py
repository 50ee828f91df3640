"""Composite queries: the six-way join, overview, WoW report, readiness."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import composite as cp
from tidemark.operators.windows import diff
from tidemark.plans import feeds as fd
from tidemark.plans import sql as S
from tidemark.plans.registry import query

W = S.with_ctes
D = S.D
M = fd.MEASURES
HISTORY_CUTOFF = dt.date(2000, 12, 30)   # last week already "published"

_SC = ", ".join(f"{m} / {D(6)} AS {m}" for m in M)
_SUM = " + ".join(f"{m} / {D(6)}" for m in M)
S.CTES.update({
    "sc": f"SELECT date, {_SC} FROM six",
    "hist": f"SELECT * FROM sc WHERE date <= DATE '{HISTORY_CUTOFF}'",
})


@query("six_way_join", W("SELECT * FROM six"))
def six_way_join(t):
    """Weeks where all six capped measures exist."""
    return fd.six_way_join(t)


@query("composite_total", W(f"SELECT date, {_SC}, {_SUM} AS composite_index FROM six"))
def composite_total(t):
    """D8 flagship: six scores (/6) and the composite out of 100."""
    return cp.composite(fd.six_way_join(t), M)


@query("overview", W(
    "SELECT * FROM hist UNION ALL SELECT sc.* FROM sc, aw, (SELECT max(date) AS mx FROM hist) h "
    "WHERE (h.mx IS NULL OR sc.date > h.mx) AND sc.date <= aw.asof"))
def overview(t):
    """Published history (weeks up to the cutoff) plus newer scores."""
    sc = cp.scores(fd.six_way_join(t), M)
    hist = sc.where(F.col("date") <= F.lit(HISTORY_CUTOFF))
    return cp.append_newer(hist, sc, "date", fd.asof_value(t))


@query("composite_change", W(f"SELECT date, composite_index, composite_index - lag(composite_index) "
                             f"OVER (ORDER BY date) AS change FROM (SELECT date, {_SUM} AS composite_index FROM six)"))
def composite_change(t):
    """First difference of the composite between consecutive published
    weeks (one row per week, so the ordered window is calendar-bounded)."""
    c = cp.composite(fd.six_way_join(t), M).select("date", "composite_index")
    return c.withColumn("change", diff("composite_index", "date"))


_PREV = ", ".join(f"{m} AS {m}__prev" for m in M)
S.CTES.update({
    "wow_w": ("SELECT six.*, p.* EXCLUDE (pdate) FROM six "
              f"JOIN (SELECT date + 7 AS pdate, {_PREV} FROM six) p ON p.pdate = six.date "
              "JOIN aw ON six.date = aw.asof"),
})


@query("wow_report", W(
    "SELECT date AS analysis_week, measure, change FROM (SELECT date, "
    f"({_SUM}) - ({' + '.join(f'{m}__prev / {D(6)}' for m in M)}) AS composite_index, "
    + ", ".join(f"{m} - {m}__prev AS {m}" for m in M) + " FROM wow_w) "
    f"UNPIVOT INCLUDE NULLS (change FOR measure IN (composite_index, {', '.join(M)}))"))
def wow_report(t):
    """Change of every measure and of the composite, analysis week vs
    the week before, computed from current feeds; long form."""
    return cp.week_over_week(fd.six_way_join(t), M, fd.asof_value(t))


S.CTES["six_o"] = S.CTES["six"].replace(".index AS", ".index_original AS")


@query("cap_history", W(
    "SELECT date, " + ", ".join(f"{S.cap(f'{m} / {D(6)}', 100.0 / 6)} AS {m}" for m in M)
    + " FROM six_o"))
def cap_history(t):
    """Uncapped history (original indices / 6) restated as min(x, 100/6)."""
    raw = cp.scores(fd.six_way_join(t, column="index_original"), M)
    return cp.cap_scores(raw, M)


_FEEDS = {"hospital": ("hospital", "d"), "claims": ("claims", "week_end"),
          "home_sales": ("home", "week_end"), "rentals": ("rentals", "week_end"),
          "subway": ("subway", "d"), "restaurants": ("restaurants", "d")}
S.CTES["feed_act"] = " UNION ".join(
    f"SELECT DISTINCT '{n}' AS feed, {c} AS date FROM {cte} WHERE index IS NOT NULL"
    for n, (cte, c) in _FEEDS.items())
S.CTES["feed_exp"] = ("SELECT f.feed, w.date FROM (VALUES " + ", ".join(f"('{n}')" for n in _FEEDS)
                      + ") f(feed), (SELECT aw.asof AS date FROM aw UNION ALL SELECT aw.asof - 7 FROM aw) w")
S.CTES["feed_st"] = ("SELECT e.feed, e.date AS week, a.feed IS NOT NULL AS present FROM feed_exp e "
                     "LEFT JOIN feed_act a ON a.feed = e.feed AND a.date = e.date")


@query("feed_status", W("SELECT feed, week, present, (SELECT bool_and(present) FROM feed_st) AS run_ready, "
                        "(SELECT bool_or(NOT present) FROM feed_st) AS any_missing FROM feed_st"))
def feed_status(t):
    """Does every feed have the analysis week and the week before? The feeds note
    their dates as they are written, so none is read for it."""
    frames = {}
    for name, (_, date) in _FEEDS.items():
        feed = getattr(fd, name)(t).select(F.col(date).alias("date"), F.col("index").alias("value"))
        written = t.dates_written(f"feed_{name}")
        if written is not None:
            days = F.split(F.lit(",".join(map(str, written))), ",")
            feed = t.spark.range(0, 1, 1, 1).select(F.explode(days).alias("day"))
            feed = feed.select(F.col("day").try_cast("date").alias("date"), F.lit(1.0).alias("value"))
        frames[name] = feed
    a = fd.asof(t)
    weeks = a.select(F.col("asof").alias("date")).unionByName(a.select(F.date_sub("asof", 7).alias("date")))
    return cp.readiness(frames, weeks)


S.CTES.update({
    "ah_new": ("SELECT day_of_week, d, avg7, index_original, index FROM restaurants"),
    "ah_hist": ("SELECT r.day_of_week, r.d, r.avg7, r.index_original, r.index, CAST(y.n AS INTEGER) AS source_n "
                f"FROM restaurants r JOIN yoy y ON y.d = r.d WHERE r.d <= DATE '{HISTORY_CUTOFF}'"),
})


@query("append_history", W(
    "SELECT * FROM ah_hist UNION ALL SELECT ah_new.*, CAST(NULL AS INTEGER) AS source_n FROM ah_new, aw, "
    "(SELECT max(d) AS mx FROM ah_hist) h WHERE (h.mx IS NULL OR ah_new.d > h.mx) AND ah_new.d <= aw.asof"))
def append_history(t):
    """The restaurant feed's stored history (with a raw-count
    column the new rows lack) plus rows newer than its max date."""
    r = fd.restaurants(t)
    raw = fd.yoy_daily(t).select("d", F.col("n").cast("int").alias("source_n"))
    hist = (r.join(raw, "d").where(F.col("d") <= F.lit(HISTORY_CUTOFF))
            .select("day_of_week", "d", "avg7", "index_original", "index", "source_n"))
    new = r.select("day_of_week", "d", "avg7", "index_original", "index",
                   F.lit(None).cast("int").alias("source_n"))   # P11: typed NA
    return cp.append_newer(hist, new, "d", fd.asof_value(t))
