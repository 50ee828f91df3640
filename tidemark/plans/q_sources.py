"""Queries of sources and sinks that know their files: embedded documents, dated files and
folders, rejected rows, published tables that grow, and rolling means by ranges."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.baseline import centred_circular, join_baseline, landed_baseline, with_stated
from tidemark.operators.ranges import rollmean_ranged as _ranged
from tidemark.plans import feeds as fd
from tidemark.plans import manifest as mf
from tidemark.plans import sql as S
from tidemark.plans.q_series import _region_year
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources import csv_io, dated, listing, payload

W = S.with_ctes

# --- S5: embedded documents ---------------------------------------------------------------

_LANG = "regexp_extract(html, '<html lang=\"([a-z]+)\"', 1)"
_BODY = ("SELECT page_id, 0 AS doc_no, lang AS name, d.h AS header, CAST(d.v AS DOUBLE) AS value FROM p, "
         "(SELECT unnest([1, 2]) AS i), LATERAL (SELECT CASE i WHEN 1 THEN '2021-01-02' ELSE '2021-01-09' END AS h, "
         "CASE i WHEN 1 THEN page_id ELSE len END AS v) d WHERE page_id % 5 IN (1, 3)")


@query("variant_payload", (
    f"WITH p AS (SELECT page_id, {_LANG} AS lang, length(html) AS len FROM pages) {_BODY} "
    "UNION ALL SELECT page_id, 0, 'page', h, v FROM p, (VALUES ('2021-01-02', CAST(0.5 AS DOUBLE)), ('2021-01-09', NULL)) x(h, v) WHERE page_id % 5 IN (1, 3) "
    "UNION ALL SELECT page_id, 1, 'second', '2021-02-06', CAST(page_id * 2 AS DOUBLE) FROM p WHERE page_id % 5 = 3"))
def variant_payload(t):
    """JSON documents assigned to a variable in page scripts, cut out of the text, parsed as
    VARIANT and zipped to rows. Every page gets a script: none, one or two documents, a broken one or
    one without series, by its number."""
    lang = F.regexp_extract("html", '<html lang="([a-z]+)"', 1)
    first = F.to_json(F.struct(F.struct(F.struct(
        F.array(F.lit("2021-01-02"), F.lit("2021-01-09")).alias("headers"),
        F.array(F.struct(lang.alias("name"), F.array(F.col("page_id").cast("string"), F.length("html").cast("string")).alias("values")),
                F.struct(F.lit("page").alias("name"), F.array(F.lit("0.5"), F.lit("n/a")).alias("values"))).alias("cities")
    ).alias("fullbook")).alias("center")))
    second = F.concat(F.lit('{"center":{"fullbook":{"headers":["2021-02-06"],\n    "cities":[{"name":"second","values":['),
                      (F.col("page_id") * 2).cast("string"), F.lit("]}]}}}"))
    script = lambda *parts: F.concat(F.lit("<script>var a=1;\n   w.__STATE__ = "), *parts, F.lit(";</script>"))
    kind = F.col("page_id") % 5
    extra = (F.when(kind == 1, script(first)).when(kind == 2, script(F.substring(first, F.lit(1), F.length(first) - 3)))
             .when(kind == 3, F.concat(script(first), script(second))).when(kind == 4, script(F.lit('{"center":{}}'))).otherwise(""))
    pages = t.pages.select("page_id", F.concat("html", extra).alias("html"))
    docs = payload.json_documents(pages, "html", r"w\w{0,5}\.__STATE__")
    return payload.variant_series(docs, "doc", "$.center.fullbook.headers", "$.center.fullbook.cities")


# --- S7: dated files ----------------------------------------------------------------------

@query("next_period_files", W("SELECT max(week_end) AS latest, max(week_end) + 7 AS next_period, count(*) AS files FROM wk"))
def next_period_files(t):
    """The weekly table written as dated CSV files; the newest period is read off the names of
    the files that are there, and the next one follows it."""
    path = scratch_path(t.spark, "dated")
    wk = fd.weekly_orders(t).withColumn("analysis_week", F.col("week_end"))
    csv_io.write_csv(wk, path, partition_by=["analysis_week"])
    found = listing.newest_dated(t.spark, path, before="analysis_week=", pattern="*.csv")
    return found.select("latest", F.date_add("latest", 7).alias("next_period"), "files")


# --- S11: bounds from metadata --------------------------------------------------------------

DAYS = 7


@query("recent_days_pruned", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events "
       f"WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM events) - {DAYS} GROUP BY 1, 2")
def recent_days_pruned(t):
    """The events laid down by day; the newest day comes from the folder names and only the
    folders of the last days are scanned."""
    path = scratch_path(t.spark, "by-day")
    dated.write_days(t.events.select("event_type", "ts"), path, "ts")
    return dated.recent_days(t.spark, path, DAYS).groupBy("event_type", "day").agg(F.count("*").alias("n"))


# --- W1-W3 over one long series -------------------------------------------------------------

_CENTS = "CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * 100) AS BIGINT)"


@query("rollmean_ranged", f"SELECT o_orderkey, cents, {S.rollmean('cents', 'o_orderdate, o_orderkey')} AS avg7 "
       f"FROM (SELECT o_orderkey, o_orderdate, {_CENTS} AS cents FROM orders)")
def rollmean_ranged(t):
    """7-row mean over all orders in order of date and key, one series without keys, in parallel."""
    o = t.orders.select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint").alias("cents"))
    return _ranged(o, "cents", fd.K, ["o_orderdate", "o_orderkey"], "avg7").drop("o_orderdate")


# --- S1/S2: rejected rows ---------------------------------------------------------------------

_BAD = "o_orderkey % 97 = 0 OR o_orderkey % 89 = 0"


@query("typed_scan_rejects", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice AS price, 'ok' AS status FROM orders "
       f"WHERE NOT ({_BAD}) UNION ALL SELECT o_orderkey, NULL, NULL, 'rejected' FROM orders WHERE {_BAD}")
def typed_scan_rejects(t):
    """Orders landed as CSV, some rows with a price or a date that is none; the rows that fit are
    read, the others are listed with their raw line."""
    text = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 89 == 0, "31.12.1999").otherwise(F.to_date("o_orderdate").cast("string")).alias("d"),
                           F.when(F.col("o_orderkey") % 97 == 0, "n.a.").otherwise(F.col("o_totalprice").cast("string")).alias("price"))
    path, rejects = scratch_path(t.spark, "landing"), scratch_path(t.spark, "rejects")
    csv_io.write_csv(text, path)
    good, _ = csv_io.read_csv_with_rejects(t.spark, path, csv_io.schema_from_codes(["o_orderkey", "d", "price"], "nDd"), rejects, max_rejects=1 << 62)
    bad = t.spark.read.parquet(rejects).select(F.split("line", ",")[0].cast("bigint").alias("o_orderkey"), F.lit("rejected").alias("status"))
    return good.withColumn("status", F.lit("ok")).unionByName(bad, allowMissingColumns=True)


# --- W6: landed baselines ---------------------------------------------------------------------

S.CTES["lb_file"] = ("SELECT area, iso_week, CAST(CASE WHEN area = 'BUILDING' AND iso_week = 53 THEN 224.5 ELSE base END AS DOUBLE) AS base "
                     "FROM (SELECT 'BUILDING' AS area, * FROM bw UNION ALL SELECT 'MACHINERY', iso_week, base FROM bw)")


@query("baseline_landed", W(
    "SELECT f.area, wk.week_end, wk.n, f.iso_week, f.base FROM wk JOIN lb_file f ON f.iso_week = " + S.isoweek("wk.week_end")))
def baseline_landed(t):
    """The weekly baseline landed as a file with a column per area and blank lines at its end. One
    area states a week 53 of its own, which stands; the other's has none and follows the rule."""
    wk = fd.weekly_orders(t)
    base = centred_circular(wk, t.base_year).select(F.col("iso_week").alias("isoweek"), F.col("base").alias("a_avg"), F.col("base").alias("b_avg"))
    stated = F.col("isoweek") == 53
    base = base.withColumns({"a_avg": F.when(stated, 224.5).otherwise(F.col("a_avg")), "b_avg": F.when(~stated, F.col("b_avg"))})
    blank = t.spark.range(107).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in base.schema])
    path = scratch_path(t.spark, "baseline")
    csv_io.write_csv(base.unionByName(blank), path)
    landed = csv_io.read_typed_csv(t.spark, path, csv_io.schema_from_codes(["isoweek", "a_avg", "b_avg"], "idd"))
    areas = landed_baseline(landed, "isoweek", {"BUILDING": "a_avg", "MACHINERY": "b_avg"})
    return join_baseline(wk, areas, "inner").select("area", "week_end", "n", "iso_week", "base")


@query("baseline_stated", W(
    "SELECT bw.iso_week, CAST(CASE WHEN bw.iso_week IN (7, 53) THEN 11155 ELSE bw.base END AS DOUBLE) AS base FROM bw "
    "UNION ALL SELECT 54, CAST(11155 AS DOUBLE)"))
def baseline_stated(t):
    """A computed baseline with stated weeks over it; a stated NULL states nothing, a week of its own joins."""
    computed = centred_circular(fd.weekly_orders(t), t.base_year)
    stated = computed.where(F.col("iso_week").isin(7, 53)).select("iso_week", F.lit(11155.0).alias("base"))
    nothing = computed.where("iso_week = 9").select("iso_week", F.lit(None).cast("double").alias("base"))
    more = t.spark.range(1).select(F.lit(54).alias("iso_week"), F.lit(11155.0).alias("base"))
    return with_stated(computed, stated.unionByName(nothing).unionByName(more))


# --- D10/D16: published tables that grow ------------------------------------------------------

_WEEKS = (dt.date(1996, 12, 28), dt.date(2000, 12, 30))
_YEARS = range(1995, 2001)


@query("published_growth", W(" UNION ALL ".join(
    f"SELECT DATE '{w}' AS analysis_week, r_name, "
    + ", ".join(f"max(n) FILTER (WHERE y = {y} AND y <= {w.year}) AS y{y}" for y in _YEARS) + f" FROM ry WHERE y <= {w.year} GROUP BY r_name" for w in _WEEKS)))
def published_growth(t):
    """The region x year matrix as two runs published it, years apart; it gained columns in between,
    which the earlier week shows as NULL."""
    long = t.stage("region_year", lambda: _region_year(t), ["orders", "customer", "nation", "region"])
    out = scratch_path(t.spark, "published")
    for number, week in enumerate(_WEEKS, 1):
        wide = long.where(F.col("y") <= week.year).groupBy("r_name").pivot("period").agg(F.max("n"))
        schemas = mf.write_run(out, week, f"run{number}", {"matrix": wide}, mf.committed(t.spark, out))
        mf.commit(t.spark, out, week, f"run{number}", schemas, number)
    return mf.read_table(t.spark, out, "matrix")
