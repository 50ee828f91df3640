"""Semi-structured sources: payloads embedded in page text, JSON columns,
and nested series (a header array of dates zipped with value arrays)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCRIPT = r"(?s)<script>(.*?)</script>"


def script_text(html: Column, marker: str) -> Column:
    """Text of the first ``<script>`` element that holds ``marker``, with
    newline+indent runs removed; NULL when no script does."""
    scripts = F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1))
    found = F.get(F.filter(scripts, lambda s: F.contains(s, F.lit(marker))), F.lit(0))
    return F.regexp_replace(found, r"\n\s+", "")


def extract_payload(text: Column, pattern: str, group: int = 1) -> Column:
    """First capture of ``pattern``, NULL when absent."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


# Schema of a nested series document: one header array of ISO dates per
# series, zipped with its value array.
SERIES_DOC = T.StructType([
    T.StructField("month", T.StringType()),
    T.StructField("series", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("headers", T.ArrayType(T.StringType())),
        T.StructField("values", T.ArrayType(T.LongType())),
    ]))),
])


def series_documents(long: DataFrame, doc_key: str, name: str, date_col: str, value_col: str) -> DataFrame:
    """Long (doc_key, name, date, value) -> one JSON document per
    (doc_key, name): ``{"month": .., "series": [{"name", "headers", "values"}]}``.
    A document holds one series' points of one month (<= 31), so no group
    grows with the data volume or with the number of series: ``doc_key`` must be a
    period of bounded length."""
    pts = (long.groupBy(doc_key, name)
           .agg(F.sort_array(F.collect_list(F.struct(F.col(date_col).cast("string").alias("h"),
                                                     F.col(value_col).alias("v")))).alias("pts")))
    ser = F.struct(F.col(name).alias("name"),
                   F.transform("pts", lambda p: p["h"]).alias("headers"),
                   F.transform("pts", lambda p: p["v"]).alias("values"))
    return pts.select(F.to_json(F.struct(F.col(doc_key).cast("string").alias("month"),
                                         F.array(ser).alias("series"))).alias("payload"))


def explode_series(docs: DataFrame, payload: str = "payload") -> DataFrame:
    """JSON documents -> (name, header, value) rows: parse with a declared
    schema, explode the series, zip headers with values, explode the points.
    A document that is no JSON fails the query rather than vanish."""
    parsed = docs.select(F.from_json(payload, SERIES_DOC, {"mode": "FAILFAST"}).alias("doc"))
    ser = parsed.select(F.explode("doc.series").alias("s"))
    pts = ser.select(F.col("s.name").alias("name"),
                     F.explode(F.arrays_zip(F.col("s.headers").alias("h"), F.col("s.values").alias("v"))).alias("p"))
    return pts.select("name", F.col("p.h").alias("header"), F.col("p.v").alias("value"))


def json_texts(text: Column, marker: str, end: str | None = None) -> Column:
    """The texts of the JSON documents that follow ``marker`` and an equals sign, as an array.

    ``marker`` is a regular expression; indented line breaks are taken out first. A document
    ends with the first ``end`` (a literal that closes it), or else with the last closing bracket
    before its script does. Without a marker the array is empty; a document whose end is
    missing is the rest as it stands, which no parser accepts."""
    flat = F.regexp_replace(text, r"\n\s+", "")
    pieces = F.split(flat, rf"(?:{marker})\s*=\s*")
    rest = F.slice(pieces, 2, F.greatest(F.size(pieces), F.lit(1)))

    def cut(piece: Column) -> Column:
        script = F.regexp_extract(piece, r"(?s)^(.*?)(?:</script>|$)", 1)
        if end is None:
            return F.regexp_replace(script, r"(?s)[^\]}]*$", "")
        at = F.instr(script, end)
        return F.when(at > 0, F.substring(script, F.lit(1), at + (len(end) - 1))).otherwise(script)

    return F.transform(rest, cut)


def json_documents(df: DataFrame, text: str, marker: str, end: str | None = None, number: str = "doc_no", out: str = "doc") -> DataFrame:
    """One row per embedded document: the columns of ``df`` without ``text``, the document's number on its page
    from 0, and the document as VARIANT; NULL where it does not parse. Pages without one give no row."""
    found = df.select(*[c for c in df.columns if c != text], F.posexplode(json_texts(F.col(text), marker, end)).alias(number, "_json"))
    return found.withColumn(out, F.try_parse_json("_json")).drop("_json")


def variant_series(docs: DataFrame, doc: str, headers: str, series: str, name: str = "name", values: str = "values") -> DataFrame:
    """(columns of ``docs`` without ``doc``, name, header, value): the series of each document zipped with its headers.

    ``headers`` and ``series`` are paths into the document. A document without them gives no row;
    a value that is no number is NULL, as is one that is missing or has no header."""
    ids = [c for c in docs.columns if c != doc]
    rows = docs.select(*ids, F.try_variant_get(doc, headers, "array<string>").alias("_headers"),
                       F.explode(F.try_variant_get(doc, series, "array<variant>")).alias("_one"))
    rows = rows.select(*ids, F.try_variant_get("_one", f"$.{name}", "string").alias("name"), "_headers",
                       F.coalesce(F.try_variant_get("_one", f"$.{values}", "array<variant>"), F.array().cast("array<variant>")).alias("_values"))
    points = rows.select(*ids, "name", F.explode(F.arrays_zip(F.col("_headers").alias("h"), F.col("_values").alias("v"))).alias("_p"))
    return points.select(*ids, "name", F.col("_p.h").alias("header"), F.try_variant_get("_p.v", "$", "double").alias("value"))
