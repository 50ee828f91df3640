"""Embedded documents, folders by day, rejected rows and rolling means by ranges."""

import datetime as dt
import os
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from paths import SF01
from tidemark.operators.ranges import rollmean_ranged
from tidemark.operators.windows import rollmean
from tidemark.sources import csv_io, dated, payload


def _fresh(name="x"):
    return os.path.join(tempfile.mkdtemp(prefix="tidemark-test-"), name)


DOC = '{"center":{"fullbook":{"headers":["2021-01-02","2021-01-03"],\n      "cities":[{"name":"New York","yoy":[-1.5,2]},{"name":"Q }","yoy":[null,"x"]}]}}}'


def test_documents_are_cut_out_of_pages(spark):
    rows = [(1, f"<p>no script, __STATE__</p>{{}}"), (2, f"<script>x()</script><script>\n  w.__STATE__ =\n {DOC};\n  go(1)</script><p>}}</p>"),
            (3, f"<script>win.__STATE__={DOC[:-4]}</script>"), (4, f"<script>w.__STATE__={DOC};</script>text<script>wi.__STATE__ = [1]</script>"),
            (5, None), (6, ""), (7, f"<script>w.__STATE__={DOC}")]
    pages = spark.createDataFrame(rows, "page_id int, html string")
    docs = payload.json_documents(pages, "html", r"w\w{0,5}\.__STATE__")
    got = {(r.page_id, r.doc_no): r.j for r in docs.select("page_id", "doc_no", F.to_json("doc").alias("j")).collect()}
    assert set(got) == {(2, 0), (3, 0), (4, 0), (4, 1), (7, 0)}
    assert got[3, 0] is None and got[4, 1] == "[1]" and got[2, 0] == got[4, 0] == got[7, 0]
    series = payload.variant_series(docs, "doc", "$.center.fullbook.headers", "$.center.fullbook.cities", values="yoy")
    points = {(r.page_id, r["name"], r.header): r.value for r in series.where("page_id = 2").collect()}
    assert points == {(2, "New York", "2021-01-02"): -1.5, (2, "New York", "2021-01-03"): 2.0,
                      (2, "Q }", "2021-01-02"): None, (2, "Q }", "2021-01-03"): None}
    assert {r.page_id for r in series.collect()} == {2, 4, 7}
    # the reference's rule: the document ends with a literal that closes it
    cut = payload.json_documents(pages.where("page_id = 2"), "html", r"w\.__STATE__", end="]}]}}}")
    assert cut.select(F.to_json("doc")).first()[0] == got[2, 0]


def test_only_the_days_asked_for_are_read(spark):
    path = _fresh("events")
    dated.write_days(spark.read.parquet(f"{SF01}/events.parquet"), path, "ts", mode="overwrite")
    assert dated.newest_day(spark, path) == dt.date(2024, 1, 30)
    recent = dated.recent_days(spark, path, 7)
    assert {r[0] for r in recent.select("day").distinct().collect()} == {dt.date(2024, 1, d) for d in range(24, 31)}
    read = recent.agg(F.max("value"))
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+ > 2024-01-23", plan), plan
    files = {r[0] for r in recent.select("_metadata.file_path").distinct().collect()}
    assert len(files) == sum(len([f for f in os.listdir(os.path.join(path, f"day=2024-01-{d}")) if f.endswith(".parquet")]) for d in range(24, 31))
    assert dated.recent_days(spark, path, 1000).count() == spark.read.parquet(f"{SF01}/events.parquet").count()


@pytest.mark.parametrize("align", ["right", "left"])
def test_ranged_mean_is_the_plain_one(spark, align):
    df = spark.range(1_000_000, numPartitions=16).select(F.xxhash64("id").alias("t"), (F.col("id") % 1013).alias("x"))
    df = df.withColumn("x", F.when(F.col("x") != 7, F.col("x")))
    got = rollmean_ranged(df, "x", 7, ["t"], "m", align, ranges=40)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    want = df.withColumn("m", rollmean("x", 7, "t", align=align))
    diff = got.join(want.select("t", F.col("m").alias("w")), "t").where(~F.col("m").eqNullSafe(F.col("w")))
    assert got.count() == 1_000_000 and diff.count() == 0


@pytest.mark.parametrize("align", ["right", "left"])
@pytest.mark.parametrize("rows,k", [(0, 3), (1, 3), (5, 7), (30, 7), (30, 1), (41, 12)])
def test_ranges_shorter_than_the_window(spark, align, rows, k):
    """More ranges than a window has rows: the border of a range comes from several."""
    df = spark.createDataFrame([(i, i * i) for i in range(rows)], "t int, x int")
    got = rollmean_ranged(df, "x", k, ["t"], "m", align, ranges=25).orderBy("t").collect()
    assert got == df.withColumn("m", rollmean("x", k, "t", align=align)).orderBy("t").collect()


def test_one_bad_row_of_a_thousand_is_reported(spark):
    path, rejects = _fresh("csv"), _fresh("rejects")
    os.makedirs(path)
    lines = [f"2020-01-01,{i}" for i in range(1000)]
    lines[500] = "2020-13-45,500"
    with open(os.path.join(path, "a.csv"), "w") as f:
        f.write("d,n\n" + "\n".join(lines) + "\n")
    schema = csv_io.schema_from_codes(["d", "n"], "Di")
    good, n = csv_io.read_csv_with_rejects(spark, path, schema, rejects, max_rejects=1)
    assert n == 1 and good.count() == 999 and good.schema == schema
    bad = spark.read.parquet(rejects).first()
    assert bad.line == "2020-13-45,500" and bad.file.endswith("a.csv")
    assert good.select("n").agg(F.sum("n")).first()[0] == sum(range(1000)) - 500     # no column's use changes what is bad
    with pytest.raises(csv_io.TooManyRejects, match="1 rows"):
        csv_io.read_csv_with_rejects(spark, path, schema, _fresh("rejects"), max_rejects=0)
