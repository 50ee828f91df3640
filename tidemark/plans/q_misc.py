"""Column, scalar, semi-structured and I/O queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week, iso_year, week_ending_saturday
from tidemark.functions.scalar import clean_name, slug, to_double, to_int_trunc
from tidemark.plans import feeds as fd
from tidemark.plans import sql as S
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources import csv_io, payload

W = S.with_ctes


# --- columns --------------------------------------------------------------------------

@query("sequential_derive", W(
    "SELECT l_orderkey, l_linenumber, CAST(disc_price AS DOUBLE) AS disc_price, "
    "CAST(CAST(disc_price * (1 + CAST(l_tax AS DECIMAL(18,2))) AS DECIMAL(18,6)) AS DOUBLE) AS charge "
    "FROM (SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) "
    "AS DECIMAL(18,4)) AS disc_price FROM lineitem)"))
def sequential_derive(t):
    """Later derived columns use earlier ones (exact decimal money)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax")
    li = li.withColumn("disc_price", (F.col("l_extendedprice").cast("decimal(18,2)")
                                      * (F.lit(1) - F.col("l_discount").cast("decimal(18,2)"))).cast("decimal(18,4)"))
    li = li.withColumn("charge", (F.col("disc_price") * (F.lit(1) + F.col("l_tax").cast("decimal(18,2)")))
                       .cast("decimal(18,6)"))
    return li.select("l_orderkey", "l_linenumber", F.col("disc_price").cast("double").alias("disc_price"),
                     F.col("charge").cast("double").alias("charge"))


@query("clean_names", W("SELECT n.n_nationkey AS nation_key, n.n_name AS name, r.r_name AS region_name "
                        "FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey"))
def clean_names(t):
    """P5 then P3: spreadsheet-style headers cleaned to snake_case (driver-side
    metadata only), then one fixed rename."""
    messy = (t.nation.join(t.region, t.nation.n_regionkey == t.region.r_regionkey)
             .select(F.col("n_nationkey").alias("Nation Key"), F.col("n_name").alias("Nation  Name"),
                     F.col("r_name").alias("Region Name ")))
    cleaned = messy.toDF(*[clean_name(c) for c in messy.columns])
    return cleaned.withColumnRenamed("nation_name", "name")


@query("column_order", W("SELECT CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, d, "
                         "CAST(revenue AS DOUBLE) AS revenue, n FROM od"))
def column_order(t):
    """Relocate a derived column before the date and a raw one to the end."""
    od = fd.orders_daily(t).withColumn("day_of_week", F.dayofweek("d"))
    od = od.withColumn("revenue", F.col("revenue").cast("double"))
    first, last = ["day_of_week"], ["n"]
    middle = [c for c in od.columns if c not in first + last and c != "n_urgent"]
    return od.select(*first, *middle, *last)


@query("slug_names", W("SELECT regexp_replace(lower(p_type || ' ' || p_name), '\\s+', '_', 'g') AS slug, "
                       "count(*) AS n_parts FROM part GROUP BY 1"))
def slug_names(t):
    """Lower-case, whitespace to underscore, over a pasted name."""
    s = t.part.select(slug(F.concat_ws(" ", "p_type", "p_name")).alias("slug"))
    return s.groupBy("slug").agg(F.count("*").alias("n_parts"))


# --- scalar functions -----------------------------------------------------------------

S.CTES["dd"] = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"


@query("calendar_fields", W(
    f"SELECT d, CAST(isoyear(d) AS INTEGER) AS iso_year, {S.isoweek('d')} AS iso_week, "
    "CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year, d + 7 AS plus_7, d - 364 AS minus_364, "
    f"CAST(date_diff('day', d, aw.asof) AS INTEGER) AS days_to_asof, {S.week_end('d')} AS week_end FROM dd, aw"))
def calendar_fields(t):
    """ISO year and week, month, year, offsets, days between, for
    every order date (the days of the staged day table)."""
    d = fd.orders_daily(t).select("d")
    c = F.col("d")
    return d.select("d", iso_year(c).alias("iso_year"), iso_week(c).alias("iso_week"),
                    F.month(c).alias("month"), F.year(c).alias("year"), F.date_add(c, 7).alias("plus_7"),
                    F.date_sub(c, 364).alias("minus_364"),
                    F.datediff(fd.asof_value(t), c).alias("days_to_asof"),
                    week_ending_saturday(c).alias("week_end"))


@query("weekday_cols", W("SELECT d, CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, "
                         "CAST(isodow(d) AS INTEGER) AS iso_weekday FROM dd"))
def weekday_cols(t):
    """Weekday from the date (Sunday = 1) and the ISO weekday (Monday = 1)."""
    d = fd.orders_daily(t).select("d")
    return d.select("d", F.dayofweek("d").alias("day_of_week"),
                    F.extract(F.lit("DAYOFWEEK_ISO"), F.col("d")).alias("iso_weekday"))


@query("date_parse", W(
    "SELECT d, s_long, CAST(strptime(s_long, '%B %d, %Y') AS DATE) AS p_long, "
    "CAST(strptime(strftime(d, '%B %Y') || ' 01', '%B %Y %d') AS DATE) AS p_month, "
    "CAST(strptime(strftime(d, '%m/%d/%Y'), '%m/%d/%Y') AS DATE) AS p_mdy, "
    "CAST(strftime(d, '%Y-%m-%d') AS DATE) AS p_iso FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, "
    "strftime(CAST(o_orderdate AS DATE), '%B %-d, %Y') AS s_long FROM orders)"))
def date_parse(t):
    """Dates rendered as text in the sources' formats and parsed back (the days of the staged day table)."""
    o = fd.orders_daily(t).select("d")
    s_long = F.date_format("d", "MMMM d, yyyy")
    return o.select(
        "d", s_long.alias("s_long"),
        F.try_to_date(s_long, "MMMM d, yyyy").alias("p_long"),
        F.try_to_date(F.concat(F.date_format("d", "MMMM yyyy"), F.lit(" 01")), "MMMM yyyy dd").alias("p_month"),
        F.try_to_date(F.date_format("d", "MM/dd/yyyy"), "MM/dd/yyyy").alias("p_mdy"),
        F.try_to_date(F.substring(F.concat(F.col("d").cast("string"), F.lit("T00:00:00")), 1, 10)).alias("p_iso"))


@query("text_scan_cast", W(
    "SELECT l_orderkey, l_linenumber, "
    "CAST(trunc(TRY_CAST(CAST(l_quantity AS VARCHAR) AS DOUBLE)) AS INTEGER) AS qty, "
    "TRY_CAST(CAST(l_extendedprice AS VARCHAR) AS DOUBLE) AS price, "
    "CAST(trunc(TRY_CAST(l_returnflag AS DOUBLE)) AS INTEGER) AS flag_num FROM lineitem"))
def text_scan_cast(t):
    """Columns landed as text, cast back; junk becomes NULL and
    integers truncate (as.integer)."""
    txt = t.lineitem.select("l_orderkey", "l_linenumber", *[F.col(c).cast("string").alias(c) for c in
                                                             ("l_quantity", "l_extendedprice", "l_returnflag")])
    return txt.select("l_orderkey", "l_linenumber", to_int_trunc(F.col("l_quantity")).alias("qty"),
                      to_double(F.col("l_extendedprice")).alias("price"),
                      to_int_trunc(F.col("l_returnflag")).alias("flag_num"))


# --- semi-structured ------------------------------------------------------------------

@query("embedded_payload", W(
    "SELECT page_id, TRY_CAST(nullif(regexp_extract(script, 'track\\((\\d+)\\)', 1), '') AS BIGINT) AS payload, "
    "CAST(instr(html, 'track(') AS INTEGER) AS pos, CAST(length(script) AS INTEGER) AS script_len "
    "FROM (SELECT page_id, html, regexp_replace(list_filter(regexp_extract_all(html, '(?s)<script>(.*?)</script>', 1), "
    "lambda s: contains(s, 'track('))[1], '\\n\\s+', '', 'g') AS script FROM pages WHERE regexp_matches(html, 'track\\('))"))
def embedded_payload(t):
    """Find pages carrying the payload, take the script that holds
    it (of several), strip indentation, extract the tracked id and locate it;
    NULL where no script holds it or the id is no number."""
    p = t.pages.where(F.col("html").rlike(r"track\("))
    s = p.select("page_id", "html", payload.script_text(F.col("html"), "track(").alias("script"))
    return s.select("page_id",
                    payload.extract_payload(F.col("script"), r"track\((\d+)\)").try_cast("bigint").alias("payload"),
                    F.instr("html", "track(").alias("pos"), F.length("script").alias("script_len"))


@query("json_props", W("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"))
def json_props(t):
    """A field of a JSON text column, parsed with a declared schema."""
    return t.events.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


@query("nested_series_explode", W(
    "SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2"))
def nested_series_explode(t):
    """Daily counts per event type packed into JSON documents (one per
    month and series: header dates + value array), then parsed with a
    declared schema, zipped and exploded back to rows."""
    daily = fd.events_type_daily(t).withColumn("month", F.trunc("d", "month"))
    docs = payload.series_documents(daily, "month", "event_type", "d", "n")
    rows = payload.explode_series(docs)
    return rows.select(F.col("name").alias("event_type"), F.to_date("header").alias("d"), F.col("value").alias("n"))


# --- I/O ------------------------------------------------------------------------------

@query("typed_scan", W(f"SELECT week_end, n, {S.isoweek('week_end')} AS iso_week FROM wk"))
def typed_scan(t):
    """Land a table as CSV in the shared scratch folder, read it back
    with a declared schema (compact type codes) instead of inference."""
    wk = fd.weekly_orders(t).select("week_end", "n", iso_week(F.col("week_end")).alias("iso_week"))
    path = scratch_path(t.spark, "typed_scan")
    csv_io.write_csv(wk, path)
    return csv_io.read_typed_csv(t.spark, path, csv_io.schema_from_codes(["week_end", "n", "iso_week"], "Dni"))


@query("untyped_scan", W(f"SELECT week_end, n, {S.isoweek('week_end')} AS iso_week FROM wk"))
def untyped_scan(t):
    """A landed CSV read with every column as text (no schema, no
    inference), then each column cast: ISO date parse, integer truncation."""
    wk = fd.weekly_orders(t).select("week_end", "n", iso_week(F.col("week_end")).alias("iso_week"))
    path = scratch_path(t.spark, "untyped_scan")
    csv_io.write_csv(wk, path)
    txt = csv_io.read_text_csv(t.spark, path)
    return txt.select(F.try_to_date("week_end").alias("week_end"),
                      F.col("n").try_cast("bigint").alias("n"),
                      to_int_trunc(F.col("iso_week")).alias("iso_week"))


def _matrix_sql():
    from tidemark.plans import q_series  # noqa: F401  (defines the ry CTE)
    return W("SELECT r.r_name, 'y' || CAST(y.y AS VARCHAR) AS period, ry.n FROM (SELECT DISTINCT r_name FROM ry) r "
             "CROSS JOIN (SELECT DISTINCT y FROM ry) y LEFT JOIN ry ON ry.r_name = r.r_name AND ry.y = y.y")


@query("matrix_scan", _matrix_sql())
def matrix_scan(t):
    """A region x year matrix landed as a spreadsheet export - one file,
    a title row padded to the matrix width above the header row - read back
    by content, melted over its period columns and cast."""
    from tidemark.operators.reshape import to_long
    from tidemark.plans.q_series import _region_year_wide
    wide = _region_year_wide(t)
    cols = wide.columns
    one = t.spark.range(1)
    title = one.select(F.lit(0).alias("_o"), F.lit("Orders by region and year").alias(cols[0]),
                       *[F.lit(None).cast("string").alias(c) for c in cols[1:]])
    header = one.select(F.lit(1).alias("_o"), *[F.lit(c).alias(c) for c in cols])
    body = wide.select(F.lit(2).alias("_o"), *[F.col(c).cast("string").alias(c) for c in cols])
    # one row per region: the sheet is small by nature, so it is written as one ordered file
    sheet = title.unionByName(header).unionByName(body).repartition(1).sortWithinPartitions("_o").drop("_o")
    path = scratch_path(t.spark, "matrix_scan")
    sheet.write.mode("overwrite").option("header", False).csv(path)
    landed = csv_io.read_matrix_csv(t.spark, path, "r_name")
    long = to_long(landed, ["r_name"], "period", "n")
    return long.select("r_name", "period", F.col("n").try_cast("bigint").alias("n"))


@query("csv_roundtrip", W("SELECT * FROM bl_out"))
def csv_roundtrip(t):
    """A table with NULLs written as CSV (NA token, ISO dates) and read
    back typed gives the same rows."""
    from tidemark.plans.q_index import baseline_left
    df = baseline_left(t)
    path = scratch_path(t.spark, "csv_roundtrip")
    csv_io.write_csv(df, path)
    return csv_io.read_typed_csv(t.spark, path, df.schema)
