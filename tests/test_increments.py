"""Aggregates kept per input file: what a run reads and what it returns."""

import os
import tempfile

from pyspark.sql import functions as F

from paths import SF01
from tidemark.sources.increments import IncrementalAggregate
from tidemark.sources.listing import file_listing, newest_dated

KEYS = {"d": F.to_date, "s": F.col}


def _aggregate(spark, source, store):
    return IncrementalAggregate(spark, source, store, {"d": F.to_date("o_orderdate"), "s": F.col("o_orderstatus")},
                                {"n": ("sum", F.lit(1)), "least": ("min", F.col("o_orderkey")), "most": ("max", F.col("o_totalprice")),
                                 "total": ("sum", F.col("o_totalprice").cast("decimal(18,2)"))})


def _whole(spark, source):
    return sorted(map(tuple, spark.read.parquet(source).groupBy(F.to_date("o_orderdate").alias("d"), F.col("o_orderstatus").alias("s")).agg(
        F.count("*"), F.min("o_orderkey"), F.max("o_totalprice"), F.sum(F.col("o_totalprice").cast("decimal(18,2)"))).collect()))


def _files(folder):
    return {f for f in os.listdir(folder) if f.endswith(".parquet")}


def test_only_new_and_changed_files_are_read(spark):
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    source, store = os.path.join(root, "orders"), os.path.join(root, "store")
    orders = spark.read.parquet(f"{SF01}/orders.parquet")
    year = lambda y: orders.where(F.year("o_orderdate") == y)
    put = lambda df: df.coalesce(1).write.mode("append").parquet(source)
    for y in (1995, 1996, 1997):
        put(year(y))
    agg = _aggregate(spark, source, store)
    first = agg.refresh()
    assert (first.new_files, first.rows_read) == (3, orders.where(F.year("o_orderdate").between(1995, 1997)).count())
    assert sorted(map(tuple, first.table.collect())) == _whole(spark, source)

    again = agg.refresh()
    assert (again.new_files, again.rows_read) == (0, 0) and sorted(map(tuple, again.table.collect())) == _whole(spark, source)

    before = _files(source)
    put(year(1998).unionByName(year(1996).limit(5)))        # late rows of old days come along
    more = agg.refresh()
    assert (more.new_files, more.rows_read) == (1, year(1998).count() + 5)
    assert sorted(map(tuple, more.table.collect())) == _whole(spark, source)

    # one file is written anew with other rows: its days are restated, nothing else is read
    name = os.path.join(source, min(before))
    changed = spark.createDataFrame(spark.read.parquet(name).limit(7).collect(), orders.schema)
    other = tempfile.mkdtemp(prefix="tidemark-test-")
    changed.coalesce(1).write.mode("overwrite").parquet(other)
    with open(os.path.join(other, min(_files(other))), "rb") as new, open(name, "wb") as old:
        old.write(new.read())
    if os.path.exists(crc := os.path.join(source, f".{os.path.basename(name)}.crc")):
        os.remove(crc)
    spark.catalog.refreshByPath(source)
    restated = agg.refresh()
    assert (restated.new_files, restated.rows_read) == (1, 7)
    assert sorted(map(tuple, restated.table.collect())) == _whole(spark, source)

    os.remove(os.path.join(source, max(before)))            # a file that is gone takes its rows with it
    spark.catalog.refreshByPath(source)
    assert sorted(map(tuple, agg.refresh().table.collect())) == _whole(spark, source)


def test_a_run_that_died_before_its_note_is_not_read(spark):
    root = tempfile.mkdtemp(prefix="tidemark-test-")
    source, store = os.path.join(root, "orders"), os.path.join(root, "store")
    spark.read.parquet(f"{SF01}/orders.parquet").limit(100).write.parquet(source)
    agg = _aggregate(spark, source, store)
    agg.refresh()
    spark.read.parquet(os.path.join(store, "partials")).drop("run_id").withColumn("run_id", F.lit("dead")) \
        .write.mode("append").partitionBy("run_id").parquet(os.path.join(store, "partials"))
    assert sorted(map(tuple, agg.refresh().table.collect())) == _whole(spark, source)


def test_listing_reads_no_content_and_finds_dates(spark):
    from tidemark.sources.csv_io import write_csv
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-test-"), "dated")
    days = spark.sql("SELECT explode(array(DATE'2021-07-17', DATE'2021-07-24', DATE'2020-02-29')) AS analysis_week").withColumn("v", F.lit(1))
    write_csv(days, out, partition_by=["analysis_week"])
    listed = file_listing(spark, out, pattern="*.csv")
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()
    assert listed.count() == 3
    got = newest_dated(spark, out, before="analysis_week=", pattern="*.csv").first()
    assert (got.latest.isoformat(), got.files) == ("2021-07-24", 3)
