"""The six measure feeds, re-aimed onto the test tables.

| measure (reference)     | feed here                                        |
|-------------------------|--------------------------------------------------|
| hospitalisations (D5)   | daily urgent orders, zero-filled on a day spine  |
| unemployment claims (D3)| weekly returned line items                       |
| home sales (D6)         | weekly orders                                    |
| rental inventory (D4)   | weekly shipped quantity                          |
| subway ridership (D2)   | daily revenue / mean of the same weekday in base |
| restaurants (D1)        | daily orders, % change to the day 364 days back  |

Every feed starts from one day-grain aggregate per fact table
(``orders_daily``, ``lineitem_daily``): a single scan with map-side partial
aggregation. Everything after that runs on one row per day or week, so the
windows and joins downstream are bounded by the calendar, not by the data.
The day-grain aggregates and the six feed tables are staged (written once per
run to the shared checkpoint folder, see ``Tables.stage``), like the
reference's per-measure tables: each fact table is scanned once per run and
every composite plan is a join of six small tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week, last_saturday_on_or_before, week_ending_saturday
from tidemark.functions.scalar import cap, ratio
from tidemark.operators import indices as ix
from tidemark.operators.baseline import centred_circular, join_baseline
from tidemark.operators.joins import chain_inner, join_dimension
from tidemark.operators.series import daily_to_weekly, decimal_to_double, money, whole, zero_fill_daily
from tidemark.operators.windows import rollmean
from tidemark.sources.tables import BASE_YEAR, SINCE, Tables  # noqa: F401  (defaults of the run's parameters)

# Fixed parameters of the re-aimed feeds; the base year, first date and analysis week
# are parameters of the run (``Tables``).
URGENT = "1-URGENT"              # order priority counted as the daily load feed
YOY_DAYS = 364                   # comparable day one year back (same weekday)
K = 7                            # rolling window, rows


def orders_category_daily(t: Tables) -> DataFrame:
    """(d, o_orderpriority, o_orderstatus, n, revenue) per order date and
    category: the one scan of ``orders`` shared by the daily feeds and the
    monthly share tables (days x 5 priorities x 3 statuses rows). Staged once
    per run."""
    return t.stage("orders_category_daily", lambda: _orders_category_daily(t), ["orders"])


def _orders_category_daily(t: Tables) -> DataFrame:
    return t.aggregate("orders", {"d": F.to_date("o_orderdate"), "o_orderpriority": F.col("o_orderpriority"), "o_orderstatus": F.col("o_orderstatus")},
                       {"n": ("sum", F.lit(1)), "revenue": ("sum", money("o_totalprice"))})


def orders_daily(t: Tables) -> DataFrame:
    """(d, n, n_urgent, revenue) per order date: a roll-up of the staged
    category table (thousands of rows), so it is not staged again."""
    return t.memo("orders_daily", lambda: _orders_daily(t))


def _orders_daily(t: Tables) -> DataFrame:
    oc = orders_category_daily(t)
    return (oc.groupBy("d")
            .agg(F.sum("n").alias("n"),
                 F.sum(F.when(F.col("o_orderpriority") == URGENT, F.col("n")).otherwise(F.lit(0))).alias("n_urgent"),
                 F.sum("revenue").cast("decimal(18,2)").alias("revenue")))


def lineitem_flag_daily(t: Tables) -> DataFrame:
    """(l_returnflag, d, n_lines, qty, revenue, discount) per return flag and
    ship date, sums as decimals: the one scan of ``lineitem`` shared by the feeds and the
    per-flag rolling means. Staged once per run."""
    return t.stage("lineitem_flag_daily", lambda: _lineitem_flag_daily(t), ["lineitem"])


def _lineitem_flag_daily(t: Tables) -> DataFrame:
    return t.aggregate("lineitem", {"l_returnflag": F.col("l_returnflag"), "d": F.to_date("l_shipdate")},
                       {"n_lines": ("sum", F.lit(1)), "qty": ("sum", money("l_quantity")),
                        "revenue": ("sum", money("l_extendedprice")), "discount": ("sum", money("l_discount"))})


def lineitem_daily(t: Tables) -> DataFrame:
    """(d, n_lines, n_returned, qty) per ship date: a roll-up of the staged
    per-flag table (a few rows per day), so it is not staged again."""
    return t.memo("lineitem_daily", lambda: _lineitem_daily(t))


def _lineitem_daily(t: Tables) -> DataFrame:
    lf = lineitem_flag_daily(t)
    return (lf.groupBy("d")
            .agg(F.sum("n_lines").alias("n_lines"),
                 F.sum(F.when(F.col("l_returnflag") == "R", F.col("n_lines")).otherwise(F.lit(0))).alias("n_returned"),
                 whole(F.sum("qty")).alias("qty")))


def events_type_daily(t: Tables) -> DataFrame:
    """(event_type, d, n): events per type and day, the one scan of
    ``events``. Staged once per run."""
    return t.stage("events_type_daily", lambda: t.aggregate(
        "events", {"event_type": F.col("event_type"), "d": F.to_date("ts")}, {"n": ("sum", F.lit(1))}), ["events"])


def asof(t: Tables) -> DataFrame:
    """One row: the analysis week of the run, or else the last Saturday on or before the last order date."""
    if t.week is not None:
        return t.memo("asof", lambda: t.spark.range(1).select(F.lit(t.week).alias("asof")))
    return t.memo("asof", lambda: orders_daily(t).agg(last_saturday_on_or_before(F.max("d")).alias("asof")))


def asof_value(t: Tables):
    """The analysis week as a scalar-subquery Column (computed once, shipped
    to every task; no collect, no cross join)."""
    return asof(t).scalar()


def weekly_orders(t: Tables) -> DataFrame:
    """(week_end, n): orders per Saturday-ending week."""
    return daily_to_weekly(orders_daily(t), "d", [], ["n"])


def weekly_returns(t: Tables) -> DataFrame:
    """(week_end, n): returned line items per week."""
    d = lineitem_daily(t).select("d", F.col("n_returned").alias("n"))
    return daily_to_weekly(d, "d", [], ["n"])


def weekly_quantity(t: Tables) -> DataFrame:
    """(week_end, qty): shipped quantity per week."""
    return daily_to_weekly(lineitem_daily(t), "d", [], ["qty"])


# --- D6 home sales: direct ratio -------------------------------------------------

def home_sales(t: Tables) -> DataFrame:
    """D6 feed: weekly orders / base-year baseline * 100, capped; one row per week. Staged once per run."""
    return t.stage("feed_home_sales", lambda: _home_sales(t), ["orders"], watch=("week_end", "index"))


def _home_sales(t: Tables) -> DataFrame:
    wk = weekly_orders(t)
    base = centred_circular(wk, t.base_year)
    s = join_baseline(wk, base, "inner")
    s = s.where(F.col("week_end").between(F.lit(t.since), asof_value(t)))
    io = ix.ratio_index(F.col("n"), F.col("base"))
    return s.select("week_end", "iso_week", "n", "base",
                    io.alias("index_original"), cap(io).alias("index"))


# --- D3 claims: inverse ratio ----------------------------------------------------

def claims(t: Tables) -> DataFrame:
    """D3 feed: weekly returned lines against their baseline, inverse ratio; one row per week. Staged once per run."""
    return t.stage("feed_claims", lambda: _claims(t), ["lineitem"], watch=("week_end", "index"))


def _claims(t: Tables) -> DataFrame:
    wk = weekly_returns(t)
    base = centred_circular(wk, t.base_year)
    s = join_baseline(wk, base, "left").where(F.col("week_end") >= F.lit(t.since))
    io = ix.inverse_index(F.col("n"), F.col("base"))
    p = ratio(F.col("n") - F.col("base"), F.col("base"))
    return s.select("week_end", "iso_week", "n", "base", p.alias("pct_change"),
                    io.alias("index_original"),
                    ix.inverse_index_capped(F.col("n"), F.col("base")).alias("index"))


# --- D4 rentals: seasonal distance -----------------------------------------------

def rentals(t: Tables) -> DataFrame:
    """D4 feed: weekly shipped quantity against the monthly seasonal model; one row per week. Staged once per run."""
    return t.stage("feed_rentals", lambda: _rentals(t), ["lineitem", "orders"], watch=("week_end", "index"))


def _rentals(t: Tables) -> DataFrame:
    wk = weekly_quantity(t)
    jan = (wk.where((F.year("week_end") == t.base_year) & (F.month("week_end") == 1))
           .agg((F.sum("qty").cast("double") / F.count("*")).alias("scale")))
    s = wk.where(F.col("week_end").between(F.lit(t.since), asof_value(t)))
    wkno = iso_week(F.col("week_end"))
    model = ix.seasonal_model(F.month("week_end"))
    adj = ix.seasonal_adjusted(F.col("qty"), wkno, jan.scalar())
    diff = ix.seasonal_difference(adj, model)
    io = ix.seasonal_index(diff)
    return s.select(wkno.alias("iso_week"), "week_end", model.alias("model"), "qty",
                    adj.alias("adjusted"), diff.alias("difference"),
                    io.alias("index_original"), cap(io).alias("index"))


# --- D5 hospitalisations: log-damped -----------------------------------------------

def hospital(t: Tables) -> DataFrame:
    """D5 feed: daily urgent orders, 7-row mean, log-damped; one row per day. Staged once per run."""
    return t.stage("feed_hospital", lambda: _hospital(t), ["orders"], watch=("d", "index"))


def _hospital(t: Tables) -> DataFrame:
    daily = orders_daily(t).select("d", F.col("n_urgent").alias("n"))
    s = zero_fill_daily(daily, "d", ["n"])
    m = rollmean("n", K, "d")
    s = s.withColumn("rolling_seven", m)
    io = ix.log_index(F.col("rolling_seven"))
    s = s.select("d", "n", "rolling_seven", F.log10(F.col("rolling_seven") + F.lit(1.0)).alias("log_hosp"),
                 io.alias("index_original"), cap(io).alias("index"))
    return s.where(F.col("index").isNotNull() & (F.col("d") <= asof_value(t)))


# --- D2 subway: comparable day ---------------------------------------------------

def subway(t: Tables) -> DataFrame:
    """D2 feed: daily revenue relative to the base year's same weekday, 7-row mean; one row per day. Staged once per run."""
    return t.stage("feed_subway", lambda: _subway(t), ["orders"], watch=("d", "index"))


def _subway(t: Tables) -> DataFrame:
    od = orders_daily(t)
    base = (od.where(F.year("d") == t.base_year)
            .groupBy(F.dayofweek("d").alias("day_of_week"))
            .agg((decimal_to_double(F.sum("revenue")) / F.count("*")).alias("base_revenue")))
    s = od.select(F.dayofweek("d").alias("day_of_week"), "d",
                  decimal_to_double(F.col("revenue")).alias("revenue"))
    s = s.join(base, "day_of_week", "inner")
    s = s.withColumn("comparable", ratio(F.col("revenue"), F.col("base_revenue")) - F.lit(1.0))
    m = rollmean("comparable", K, "d")
    s = s.select("day_of_week", "d", "comparable", m.alias("avg7"),
                 rollmean("revenue", K, "d").alias("avg_revenue"))
    io = ix.comparable_index(F.col("avg7"))
    s = s.select("day_of_week", "d", "comparable", "avg7", io.alias("index_original"),
                 cap(io).alias("index"), "avg_revenue")
    return s.where(F.col("d") <= asof_value(t))


# --- D1 restaurants: shift of a YoY percent ----------------------------------------

def yoy_daily(t: Tables) -> DataFrame:
    """(d, n, n_old, yoy): percent change of daily orders to the same weekday
    one year back; only days present in both (the feed stays sparse)."""
    od = orders_daily(t).select("d", "n")
    old = od.select(F.date_add("d", YOY_DAYS).alias("d"), F.col("n").alias("n_old"))
    j = od.join(old, "d", "inner")
    return j.withColumn("yoy", ratio(F.col("n") - F.col("n_old"), F.col("n_old")) * F.lit(100.0))


def restaurants(t: Tables) -> DataFrame:
    """D1 feed: 7-row mean of the daily YoY percent change + 100; one row per day. Staged once per run."""
    return t.stage("feed_restaurants", lambda: _restaurants(t), ["orders"], watch=("d", "index"))


def _restaurants(t: Tables) -> DataFrame:
    s = yoy_daily(t).withColumn("avg7", rollmean("yoy", K, "d"))
    io = ix.shift_index(F.col("avg7"))
    s = s.select(F.dayofweek("d").alias("day_of_week"), "d", "yoy", "avg7",
                 io.alias("index_original"), cap(io).alias("index"))
    return s.where(F.col("d") <= asof_value(t))


# --- J4 / D8 composite -------------------------------------------------------------

MEASURES = ("hosp_index", "claims_index", "home_sales_index", "rental_index",
            "subway_index", "restaurant_index")


def measure_frames(t: Tables, column: str = "index") -> list[DataFrame]:
    """The six feeds at (date, value) grain, in the published column order."""
    return [
        hospital(t).select(F.col("d").alias("date"), F.col(column).alias("hosp_index")),
        claims(t).select(F.col("week_end").alias("date"), F.col(column).alias("claims_index")),
        home_sales(t).select(F.col("week_end").alias("date"), F.col(column).alias("home_sales_index")),
        rentals(t).select(F.col("week_end").alias("date"), F.col(column).alias("rental_index")),
        subway(t).select(F.col("d").alias("date"), F.col(column).alias("subway_index")),
        restaurants(t).select(F.col("d").alias("date"), F.col(column).alias("restaurant_index")),
    ]


def six_way_join(t: Tables, column: str = "index") -> DataFrame:
    """Weeks where every measure has a value (inner-join chain on date); one row per week, staged once per run."""
    return t.stage(f"six_way_{column}", lambda: chain_inner(measure_frames(t, column), "date").select("date", *MEASURES),
                   ["orders", "lineitem"])


# --- area (market segment) feeds ----------------------------------------------------

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
ALL_AREAS = "ALL"


def segment_daily(t: Tables) -> DataFrame:
    """(area, d, n, n_finished, price): orders per market segment and day,
    staged once per run (every consumer reads the small staged table)."""
    return t.stage("segment_daily", lambda: _segment_daily(t), ["orders", "customer"])


def _segment_daily(t: Tables) -> DataFrame:
    """Orders join the customer dimension (``join_dimension``). Either way the (segment, day) aggregate is partial before its
    shuffle. ``n_finished`` sums a value that is NULL for unfinished orders,
    so a group without finished orders sums to NULL (see ``grain_sum``)."""
    o = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("d"), F.lit(1).cast("long").alias("n"),
                        F.when(F.col("o_orderstatus") == "F", F.lit(1)).cast("long").alias("n_finished"),
                        money("o_totalprice").alias("price"))
    sums = [F.sum("n").alias("n"), F.sum("n_finished").alias("n_finished"), F.sum("price").alias("price")]
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("area"))
    j = join_dimension(o, c, "o_custkey", t.size_bytes("customer"),
                       pre_aggregate=lambda df: df.groupBy("o_custkey", "d").agg(*sums))
    return j.groupBy("area", "d").agg(*sums)


def segment_weekly(t: Tables, with_all: bool = False) -> DataFrame:
    """(area, week_end, n); optionally plus the all-segment total as area ALL."""
    wk = t.stage("segment_weekly", lambda: _segment_weekly(t), ["orders", "customer"])
    return wk.drop("total") if with_all else wk.where(~F.col("total")).drop("total")


def _segment_weekly(t: Tables) -> DataFrame:
    """One aggregate gives the segments' weeks and, as area ALL, the weeks of all of them."""
    sd = segment_daily(t).withColumn("week_end", week_ending_saturday(F.col("d")))
    g = sd.groupingSets([("area", "week_end"), ("week_end",)], "area", "week_end").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.grouping("area").alias("g"))
    return g.select(F.when(F.col("g") == 1, ALL_AREAS).otherwise(F.col("area")).alias("area"), "week_end", "n",
                    (F.col("g") == 1).alias("total"))
