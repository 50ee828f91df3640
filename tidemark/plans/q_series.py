"""Series queries: windows, horizons, shares, reshape, aggregates, filters
and history look-ups over the test tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import os

from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week, week_ending_saturday
from tidemark.functions.scalar import clean_name
from tidemark.operators.baseline import centred_circular, join_baseline
from tidemark.operators.indices import ratio_index
from tidemark.operators.joins import join_dimension
from tidemark.operators.reshape import share_of_total, to_long, to_wide, union_tagged, wide_names
from tidemark.operators.series import daily_to_weekly, decimal_to_double, money, whole
from tidemark.operators.windows import horizon_change as _horizon_change
from tidemark.operators.windows import rollmean
from tidemark.plans import feeds as fd
from tidemark.plans import sql as S
from tidemark.plans.registry import query
from tidemark.session import checkpoint_root
from tidemark.sources.increments import IncrementalAggregate

W = S.with_ctes
D = S.D
SEG = fd.SEGMENTS
RECENT_DAYS = 91          # source-side window of the daily pull (13 weeks)
SHIP_FROM = dt.date(1997, 1, 1)


# --- windows --------------------------------------------------------------------------

@query("rollmean_trailing", W(f"SELECT d, n, {S.rollmean('n', 'd')} AS avg7 FROM od"))
def rollmean_trailing(t):
    """Trailing 7-row mean of daily orders (rows, not days)."""
    od = fd.orders_daily(t)
    return od.select("d", "n", rollmean("n", fd.K, "d").alias("avg7"))


@query("rollmean_left", W(f"SELECT d, qty, {S.rollmean('qty', 'd', align='left')} AS avg7 FROM ld"))
def rollmean_left(t):
    """Leading-aligned 7-row mean (rows t..t+6) of daily shipped quantity."""
    ld = fd.lineitem_daily(t)
    return ld.select("d", "qty", rollmean("qty", fd.K, "d", align="left").alias("avg7"))


_ACROSS = ("n_lines", "qty", "revenue", "discount")
S.CTES["lf"] = ("SELECT l_returnflag, CAST(l_shipdate AS DATE) AS d, count(*) AS n_lines, "
                "CAST(coalesce(round(sum(CAST(l_quantity AS DECIMAL(18,2)))), 0) AS BIGINT) AS qty, "
                "CAST(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS revenue, "
                "CAST(CAST(sum(CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS discount "
                "FROM lineitem GROUP BY 1, 2")


@query("across_rollmean", W("SELECT l_returnflag, d, " + ", ".join(
    f"{S.rollmean(c, 'd', 'l_returnflag')} AS {c}" for c in _ACROSS) + " FROM lf"))
def across_rollmean(t):
    """The 7-row mean of every measure column, per return flag
    (from the staged per-flag day table)."""
    lf = fd.lineitem_flag_daily(t)
    g = lf.select("l_returnflag", "d", "n_lines", whole(F.col("qty")).alias("qty"),
                  decimal_to_double(F.col("revenue")).alias("revenue"),
                  decimal_to_double(F.col("discount")).alias("discount"))
    ids = ["l_returnflag", "d"]
    measures = [c for c in g.columns if c not in ids]
    return g.select(*ids, *[rollmean(c, fd.K, "d", ids[:1]).alias(c) for c in measures])


_SEGCOLS = [clean_name(s) for s in SEG]
S.CTES["sc7"] = (f"SELECT area, d, {S.rollmean('n', 'd', 'area')} AS avg7 FROM sd")


@query("series_compare", W("SELECT d, " + ", ".join(
    f"max(avg7) FILTER (WHERE area = '{s}') AS {c}" for s, c in zip(SEG, _SEGCOLS))
    + " FROM sc7, aw WHERE d <= aw.asof GROUP BY d"))
def series_compare(t):
    """Five series side by side, each a 7-row mean of its own rows,
    pivoted wide at the sink, up to the analysis week."""
    sd = fd.segment_daily(t).where(F.col("area").isin(*SEG))
    s = sd.select("area", "d", rollmean("n", fd.K, "d", ["area"]).alias("avg7"))
    s = s.where(F.col("d") <= fd.asof_value(t))
    return to_wide(s, ["d"], "area", "avg7", SEG)


S.CTES["rd"] = ("SELECT r.r_name, CAST(l.l_shipdate AS DATE) AS d, count(*) AS n_lines, "
                "CAST(coalesce(round(sum(CAST(l.l_quantity AS DECIMAL(18,2)))), 0) AS BIGINT) AS qty FROM lineitem l "
                "JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey "
                "JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1, 2")


@query("facility_rollup", W(f"SELECT r_name, d, n_lines, qty, {S.rollmean('n_lines', 'd', 'r_name')} AS lines7, "
                            f"{S.rollmean('qty', 'd', 'r_name')} AS qty7 FROM rd"))
def facility_rollup(t):
    """Line items per supplier (facility) and day, rolled up to
    region x day (a scan of ``lineitem`` of its own), then 7-row means per region."""
    g = t.stage("region_daily", lambda: _region_daily(t), ["lineitem", "supplier", "nation", "region"])
    return g.select("r_name", "d", "n_lines", "qty",
                    rollmean("n_lines", fd.K, "d", ["r_name"]).alias("lines7"),
                    rollmean("qty", fd.K, "d", ["r_name"]).alias("qty7"))


def _region_daily(t):
    """(r_name, d, n_lines, qty): line items by the supplier's region and ship day."""
    li = t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("d"),
                           F.lit(1).cast("long").alias("n_lines"), money("l_quantity").alias("qty"))
    sums = [F.sum("n_lines").alias("n_lines"), F.sum("qty").alias("qty")]
    geo = (t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("n_nationkey"))
           .join(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey")
           .join(t.region.select("r_regionkey", "r_name"), "r_regionkey")
           .select("l_suppkey", "r_name"))
    j = join_dimension(li, geo, "l_suppkey", t.size_bytes("supplier", "nation", "region"),
                       pre_aggregate=lambda df: df.groupBy("l_suppkey", "d").agg(*sums))
    return j.groupBy("r_name", "d").agg(sums[0], whole(F.sum("qty")).alias("qty"))


# --- horizons -------------------------------------------------------------------------

S.CTES["hz_cur"] = ("SELECT m.area, m.mx, s.n AS new FROM (SELECT area, max(week_end) AS mx FROM swa GROUP BY area) m "
                    "JOIN swa s ON s.area = m.area AND s.week_end = m.mx")


def _hz_sql(values: str) -> str:
    return W("SELECT h.change, c.area, " + S.pct_chg("c.new", "CASE WHEN o.area IS NULL THEN c.new ELSE o.n END") + " AS chg "
             f"FROM hz_cur c JOIN (SELECT area, mx, change, days_back FROM hz_cur, ({values}) v(change, days_back)) h "
             "ON h.area = c.area LEFT JOIN swa o ON o.area = c.area AND o.week_end = c.mx - CAST(h.days_back AS INTEGER)")


HORIZONS = [("WoW", 7), ("MoM", 28), ("YoY", 364)]
_HZ3 = ", ".join(f"('{n}', {b})" for n, b in HORIZONS)


@query("horizon_change", _hz_sql(f"VALUES {_HZ3}, ('19_present', -1)").replace(
    "v(change, days_back)) h", "v(change, db), LATERAL (SELECT CASE WHEN db < 0 THEN "
    f"364 * (year(mx) - {fd.BASE_YEAR}) ELSE db END AS days_back)) h"))
def horizon_change(t):
    """Area x {WoW, MoM, YoY, since the base year} percent change of weekly orders."""
    back = F.lit(364) * (F.year("mx") - F.lit(t.base_year))
    return _horizon_change(fd.segment_weekly(t, with_all=True), ["area"], "week_end", "n",
                           [*HORIZONS, ("19_present", back)])


S.CTES["rw"] = (f"SELECT r_name AS area, {S.week_end('d')} AS week_end, CAST(sum(qty) AS BIGINT) AS n FROM rd GROUP BY 1, 2 "
                f"UNION ALL SELECT 'ALL', {S.week_end('d')}, CAST(sum(qty) AS BIGINT) FROM rd GROUP BY 2")


S.CTES["rw_cur"] = ("SELECT m.area, m.mx, s.n AS new FROM (SELECT area, max(week_end) AS mx FROM rw GROUP BY area) m "
                    "JOIN rw s ON s.area = m.area AND s.week_end = m.mx")


@query("rental_change", W("SELECT h.change, c.area, " + S.pct_chg("c.new", "CASE WHEN o.area IS NULL THEN c.new ELSE o.n END")
                          + f" AS chg FROM rw_cur c, (VALUES {_HZ3}) h(change, days_back) LEFT JOIN rw o "
                          "ON o.area = c.area AND o.week_end = c.mx - CAST(h.days_back AS INTEGER)"))
def rental_change(t):
    """Area x {WoW, MoM, YoY} percent change of the weekly shipped quantity by region."""
    daily = t.stage("region_daily", lambda: _region_daily(t), ["lineitem", "supplier", "nation", "region"])
    weekly = daily_to_weekly(daily.withColumnRenamed("r_name", "area"), "d", ["area"], ["qty"])
    total = weekly.groupBy("week_end").agg(F.sum("qty").alias("qty")).withColumn("area", F.lit(fd.ALL_AREAS))
    return _horizon_change(weekly.unionByName(total), ["area"], "week_end", "qty", HORIZONS)


@query("horizon_since_base", _hz_sql(
    f"SELECT '19_present', 364 * (year(mx) - {fd.BASE_YEAR}) FROM hz_cur x WHERE x.area = hz_cur.area"))
def horizon_since_base(t):
    """Change since the base year, 364 days x whole years back."""
    back = F.lit(364) * (F.year("mx") - F.lit(t.base_year))
    return _horizon_change(fd.segment_weekly(t, with_all=True), ["area"], "week_end", "n",
                           [("19_present", back)])


# --- shares ---------------------------------------------------------------------------

S.CTES["mp"] = ("SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month, "
                "o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
S.CTES["mps"] = ("SELECT month, o_orderpriority, "
                 + S.rhe("n", "sum(n) OVER (PARTITION BY month)", 2, 100) + " AS share FROM mp")


def _month_group(t, col="o_orderpriority"):
    """Orders per month and category, rolled up from the staged day table."""
    oc = fd.orders_category_daily(t)
    return oc.groupBy(F.trunc("d", "month").alias("month"), col).agg(F.sum("n").alias("n"))


def _month_priority(t):
    return _month_group(t, "o_orderpriority")


@query("share_by_group", W("SELECT * FROM mps"))
def share_by_group(t):
    """Share of each priority in its month's total, rounded to 2."""
    return share_of_total(_month_priority(t), ["month"], "n")


def _pivot_sql(rows: str, ids: str, key: str, value: str, keys, prefix: str = "", suffix: str = "") -> str:
    """DuckDB pivot over the listed keys of the test data, named as ``to_wide`` names them.

    The operator reads its keys from the data; a view needs columns that are known beforehand."""
    cells = ", ".join(f"max({value}) FILTER (WHERE {key} = '{k}') AS {n}" for k, n in zip(keys, wide_names(keys, prefix, suffix)))
    return f"SELECT {ids}, {cells} FROM ({W(rows)}) GROUP BY {ids}"


_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
_STATUSES = ("F", "O", "P")


@query("share_wide", _pivot_sql("SELECT * FROM mps", "month", "o_orderpriority", "share", _PRIORITIES))
def share_wide(t):
    """The month x priority shares, one column per priority of the data."""
    return to_wide(share_of_total(_month_priority(t), ["month"], "n"), ["month"], "o_orderpriority", "share")


S.CTES["mss"] = ("SELECT month, o_orderstatus, " + S.rhe("n", "sum(n) OVER (PARTITION BY month)", 2, 100)
                 + " AS share FROM (SELECT CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS month, "
                 "o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)")


@query("share_wide_status", _pivot_sql("SELECT * FROM mss", "month", "o_orderstatus", "share", _STATUSES, "status_"))
def share_wide_status(t):
    """D16, second parameter set: the same monthly share job grouped by
    order status instead of priority."""
    return to_wide(share_of_total(_month_group(t, "o_orderstatus"), ["month"], "n"), ["month"],
                   "o_orderstatus", "share", prefix="status_")


@query("share_weekly", _pivot_sql("SELECT week_end, area, " + S.rhe("n", "sum(n) OVER (PARTITION BY week_end)", 2, 100)
                                  + " AS share FROM sw", "week_end", "area", "share", SEG))
def share_weekly(t):
    """Weekly share of orders by market segment, wide."""
    s = share_of_total(fd.segment_weekly(t), ["week_end"], "n")
    return to_wide(s, ["week_end"], "area", "share")


# --- area index -----------------------------------------------------------------------

S.CTES.update(S.baseline_ctes("ba", "swa", keys="area"))
@query("wide_area_index", f"SELECT *, {S.isoweek('week_end')} AS iso_week FROM (" + _pivot_sql(
    f"SELECT s.area, s.week_end, {S.ratio('s.n', 'b.base')} * {D(100)} AS idx FROM swa s "
    f"LEFT JOIN ba b ON b.area = s.area AND b.iso_week = {S.isoweek('s.week_end')} "
    f"WHERE s.week_end >= DATE '{fd.SINCE}'", "week_end", "area", "idx", (*SEG, fd.ALL_AREAS), suffix="_index") + ")")
def wide_area_index(t):
    """Per-area ratio index (uncapped) against each area's own
    baseline, one computed column per area; rows matched by week, not position."""
    wk = fd.segment_weekly(t, with_all=True)
    base = centred_circular(wk, t.base_year, keys=["area"])
    s = join_baseline(wk, base, "left", keys=["area"]).where(F.col("week_end") >= F.lit(t.since))
    s = s.select("area", "week_end", ratio_index(F.col("n"), F.col("base")).alias("idx"))
    return to_wide(s, ["week_end"], "area", "idx", suffix="_index").withColumn("iso_week", iso_week(F.col("week_end")))


# --- reshape --------------------------------------------------------------------------

S.CTES["ry"] = ("SELECT r.r_name, year(CAST(o.o_orderdate AS DATE)) AS y, count(*) AS n FROM orders o "
                "JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey "
                "JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1, 2")


def _region_year(t):
    o = t.orders.select("o_custkey", F.year(F.to_date("o_orderdate")).alias("y"), F.lit(1).cast("long").alias("n"))
    geo = (t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"))
           .join(t.nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey")), "n_nationkey")
           .join(t.region.select("r_regionkey", "r_name"), "r_regionkey").select("o_custkey", "r_name"))
    j = join_dimension(o, geo, "o_custkey", t.size_bytes("customer", "nation", "region"),
                       pre_aggregate=lambda df: df.groupBy("o_custkey", "y").agg(F.sum("n").alias("n")))
    return (j.groupBy("r_name", "y").agg(F.sum("n").alias("n"))
            .withColumn("period", F.concat(F.lit("y"), F.col("y").cast("string"))))


def _region_year_wide(t):
    """Region x year matrix with one column per year present in the data.
    The long aggregate is staged first, so the distinct-years job Spark runs
    for a value-less pivot reads a table of (regions x years) rows."""
    long = t.stage("region_year", lambda: _region_year(t), ["orders", "customer", "nation", "region"])
    return long.groupBy("r_name").pivot("period").agg(F.max("n"))


@query("wide_to_long", W(
    "SELECT r.r_name, 'y' || CAST(y.y AS VARCHAR) AS period, ry.n FROM (SELECT DISTINCT r_name FROM ry) r "
    "CROSS JOIN (SELECT DISTINCT y FROM ry) y LEFT JOIN ry ON ry.r_name = r.r_name AND ry.y = y.y"))
def wide_to_long(t):
    """A region x year matrix (one column per year) back to long
    form over every non-id column, NULL cells kept."""
    return to_long(_region_year_wide(t), ["r_name"], "period", "n")


@query("long_to_wide", _pivot_sql("SELECT * FROM mp", "month", "o_orderpriority", "n", _PRIORITIES))
def long_to_wide(t):
    """Order counts month x priority, one column per priority; a
    missing cell is NULL, not 0."""
    return to_wide(_month_priority(t), ["month"], "o_orderpriority", "n")


S.CTES["wu"] = f"SELECT {S.week_end('d')} AS week_end, CAST(sum(n_urgent) AS BIGINT) AS n FROM od GROUP BY 1"
S.CTES["wl"] = f"SELECT {S.week_end('d')} AS week_end, CAST(sum(n_lines) AS BIGINT) AS n FROM ld GROUP BY 1"


@query("area_union", W("SELECT week_end, n, 'orders' AS feed FROM wk UNION ALL SELECT week_end, n, 'urgent' FROM wu "
                       "UNION ALL SELECT week_end, n, 'lines' FROM wl UNION ALL SELECT week_end, n, 'returns' FROM wr"))
def area_union(t):
    """One weekly table per source, tagged and unioned by name."""
    od, ld = fd.orders_daily(t), fd.lineitem_daily(t)
    return union_tagged({
        "orders": fd.weekly_orders(t),
        "urgent": daily_to_weekly(od.select("d", F.col("n_urgent").alias("n")), "d", [], ["n"]),
        "lines": daily_to_weekly(ld.select("d", F.col("n_lines").alias("n")), "d", [], ["n"]),
        "returns": fd.weekly_returns(t),
    }, tag="feed")


# --- increments ------------------------------------------------------------------------

@query("incremental_daily", W(
    "SELECT CAST(o_orderdate AS DATE) AS d, o_orderstatus, count(*) AS n, min(o_totalprice) AS least, max(o_totalprice) AS most, "
    "CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS revenue FROM orders GROUP BY 1, 2"))
def incremental_daily(t):
    """Day aggregates merged from partial ones kept per input file; a later call over the same
    folder reads the files that are new or changed since."""
    place = hashlib.sha256(t.path("orders").encode()).hexdigest()[:16]
    store = os.path.join(checkpoint_root(t.spark), "increments", f"orders-{place}")
    found = IncrementalAggregate(
        t.spark, t.path("orders"), store, {"d": F.to_date("o_orderdate"), "o_orderstatus": F.col("o_orderstatus")},
        {"n": ("sum", F.lit(1)), "least": ("min", F.col("o_totalprice")), "most": ("max", F.col("o_totalprice")),
         "revenue": ("sum", money("o_totalprice"))}).refresh()
    return found.table.withColumn("revenue", decimal_to_double(F.col("revenue")))


# --- aggregates -----------------------------------------------------------------------

@query("grain_sum", W(
    f"SELECT c.c_mktsegment AS area, {S.week_end('CAST(o.o_orderdate AS DATE)')} AS week_end, count(*) AS n, "
    "CAST(COALESCE(sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 END), 0) AS BIGINT) AS n_finished, "
    "CAST(CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE) AS price "
    "FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2"))
def grain_sum(t):
    """Segment x week sums; a group whose summed values are all NULL
    sums to 0 (R's sum(na.rm=TRUE)), not NULL."""
    sd = fd.segment_daily(t).withColumn("week_end", week_ending_saturday(F.col("d")))
    return (sd.groupBy("area", "week_end")
            .agg(F.sum("n").alias("n"),
                 F.coalesce(F.sum("n_finished"), F.lit(0).cast("long")).alias("n_finished"),
                 decimal_to_double(F.sum("price")).alias("price")))


@query("multi_sum", W(
    "SELECT CAST(l_shipdate AS DATE) AS d, "
    "CAST(coalesce(sum(CAST(trunc(TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE)) AS INTEGER)), 0) AS BIGINT) AS qty, "
    "CAST(CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(18,2)) AS DOUBLE) AS price, "
    "CAST(CAST(coalesce(sum(CAST(l_tax AS DECIMAL(18,2))), 0) AS DECIMAL(18,2)) AS DOUBLE) AS tax "
    "FROM lineitem GROUP BY 1"))
def multi_sum(t):
    """A2: several sums per ship date with the cast inside the sum."""
    from tidemark.functions.scalar import to_int_trunc
    li = t.lineitem.select(F.to_date("l_shipdate").alias("d"), "l_quantity", "l_extendedprice", "l_tax")
    return (li.groupBy("d")
            .agg(F.coalesce(F.sum(to_int_trunc(F.col("l_quantity").cast("string"))), F.lit(0)).alias("qty"),
                 decimal_to_double(F.coalesce(F.sum(money("l_extendedprice")), F.lit(0))).alias("price"),
                 decimal_to_double(F.coalesce(F.sum(money("l_tax")), F.lit(0))).alias("tax")))


@query("min_max_dates", W(
    "SELECT * FROM (SELECT CAST(min(o_orderdate) AS DATE) AS first_order, CAST(max(o_orderdate) AS DATE) AS last_order "
    "FROM orders), (SELECT CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship "
    "FROM lineitem)"))
def min_max_dates(t):
    """A5: global extremes of the order and ship dates, one row, from the
    staged day tables; the two one-row aggregates are unioned and pivoted."""
    o = fd.orders_daily(t).agg(F.lit("order").alias("src"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    li = fd.lineitem_daily(t).agg(F.lit("ship").alias("src"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    wide = (o.unionByName(li).groupBy().pivot("src", ["order", "ship"])
            .agg(F.max("lo").alias("first"), F.max("hi").alias("last")))
    return wide.select(F.col("order_first").alias("first_order"), F.col("order_last").alias("last_order"),
                       F.col("ship_first").alias("first_ship"), F.col("ship_last").alias("last_ship"))


# --- filters and sorts -----------------------------------------------------------------

@query("filter_eq", W(f"SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders "
                      f"WHERE o_orderpriority = '{fd.URGENT}'"))
def filter_eq(t):
    """equality on a category (pushed to the parquet scan)."""
    return (t.orders.where(F.col("o_orderpriority") == fd.URGENT)
            .select("o_orderkey", F.to_date("o_orderdate").alias("d"), "o_totalprice"))


_IN = ("AUTOMOBILE", "BUILDING", "MACHINERY")


@query("filter_in", W("SELECT area, d, n FROM sd WHERE area IN (" + ", ".join(f"'{s}'" for s in _IN) + ")"))
def filter_in(t):
    """membership in a list of series."""
    return fd.segment_daily(t).where(F.col("area").isin(*_IN)).select("area", "d", "n")


@query("filter_between", W(
    f"SELECT {S.week_end('CAST(l_shipdate AS DATE)')} AS week_end, CAST(coalesce(round(sum(CAST(l_quantity AS DECIMAL(18,2)))), 0) AS BIGINT) AS qty "
    f"FROM lineitem, aw WHERE l_shipdate >= TIMESTAMP '{SHIP_FROM} 00:00:00' "
    f"AND CAST(l_shipdate AS DATE) BETWEEN DATE '{fd.SINCE}' AND aw.asof + 1 GROUP BY 1"))
def filter_between(t):
    """a literal lower bound on the raw column (pushed to parquet) and a
    closed range up to the day after the analysis week."""
    li = t.lineitem.where(F.col("l_shipdate") >= F.lit(dt.datetime(SHIP_FROM.year, SHIP_FROM.month, SHIP_FROM.day)))
    li = li.select(F.to_date("l_shipdate").alias("d"), "l_quantity")
    li = li.where(F.col("d").between(F.lit(t.since), F.date_add(fd.asof_value(t), 1)))
    return (li.groupBy(week_ending_saturday(F.col("d")).alias("week_end"))
            .agg(whole(F.sum(money("l_quantity"))).alias("qty")))


@query("sort_desc", W("SELECT d, n FROM od ORDER BY d DESC"))
def sort_desc(t):
    """O1: newest first."""
    return fd.orders_daily(t).select("d", "n").orderBy(F.col("d").desc())


@query("sort_asc", W(f"SELECT d, {S.rollmean('n', 'd')} AS avg7 FROM od ORDER BY avg7 ASC NULLS LAST, d"))
def sort_asc(t):
    """O2: ascending with NULLs last (dplyr's order; Spark's asc puts them first)."""
    s = fd.orders_daily(t).select("d", rollmean("n", fd.K, "d").alias("avg7"))
    return s.orderBy(F.col("avg7").asc_nulls_last(), "d")


# --- history --------------------------------------------------------------------------

@query("asof_cutoff", W(f"SELECT d, n, {S.rollmean('n', 'd')} AS avg7 FROM od, aw "
                        f"QUALIFY d <= aw.asof"))
def asof_cutoff(t):
    """The 7-row mean is computed on all rows, then cut at the
    analysis week (a cut before the window would change the first means)."""
    od = fd.orders_daily(t)
    s = od.select("d", "n", rollmean("n", fd.K, "d").alias("avg7"))
    return s.where(F.col("d") <= fd.asof_value(t))


@query("recent_days_limit", W(f"SELECT d, n FROM od WHERE d > (SELECT max(d) FROM od) - {RECENT_DAYS}"))
def recent_days_limit(t):
    """The pull of the last n days, as a date predicate on the staged day
    table rather than a row cap."""
    od = fd.orders_daily(t)
    newest = od.agg(F.max("d")).scalar()
    return od.where(F.col("d") > F.date_sub(newest, RECENT_DAYS)).select("d", "n")


@query("next_period", W(
    "SELECT max(p) AS latest, max(p) + 7 AS next_period FROM (SELECT CAST(regexp_extract(name, "
    "'(\\d{4}-\\d{2}-\\d{2})_', 1) AS DATE) AS p FROM (SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || "
    "'_orders.csv' AS name FROM orders UNION ALL SELECT url FROM pages) WHERE regexp_extract(name, "
    "'(\\d{4}-\\d{2}-\\d{2})_', 1) <> '')"))
def next_period(t):
    """The latest period found in a column of file names (one dated name per
    day of the staged day table, and the page URLs), plus 7 days. Names without a date
    are dropped; the top-1 is a max() aggregate. The publish job does the same over
    its manifest (``publish.next_week``)."""
    pat = r"(\d{4}-\d{2}-\d{2})_"
    names = (fd.orders_daily(t).select(F.concat(F.col("d").cast("string"), F.lit("_orders.csv")).alias("name"))
             .unionByName(t.pages.select(F.col("url").alias("name"))))
    found = names.select(F.regexp_extract("name", pat, 1).alias("p")).where(F.col("p") != "")
    return found.agg(F.max(F.to_date("p")).alias("latest")).select("latest", F.date_add("latest", 7).alias("next_period"))
