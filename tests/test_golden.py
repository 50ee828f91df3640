"""Golden rows: published input/output pairs typed in as literals (FIXTURES.md)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week
from tidemark.functions.scalar import cap
from tidemark.operators import indices as ix


def test_claims_inverse_index(spark):
    # claims index, two published weeks (the second caps at 100)
    df = spark.createDataFrame([(6740, 5576.666667), (4830, 5120.0)], "x long, b double")
    r = df.select(ix.inverse_index(F.col("x"), F.col("b")).alias("o"),
                  ix.inverse_index_capped(F.col("x"), F.col("b")).alias("c")).collect()
    assert math.isclose(r[0].o, 82.73986152818992, rel_tol=1e-12) and r[0].c == r[0].o
    assert math.isclose(r[1].o, 106.00414078674949, rel_tol=1e-12) and r[1].c == 100.0


def test_home_sales_ratio_index(spark):
    df = spark.createDataFrame([(374, 351.3333333)], "x long, b double")
    r = df.select(ix.ratio_index(F.col("x"), F.col("b")).alias("o")).first()
    assert math.isclose(r.o, 106.45161291332559, rel_tol=1e-12)
    assert df.select(cap(ix.ratio_index(F.col("x"), F.col("b")))).first()[0] == 100.0


def test_rental_seasonal_index(spark):
    # rental index, one published week: 2022-12-03, inventory 16530, scale 16366.8
    df = spark.createDataFrame([(dt.date(2022, 12, 3), 16530, 16366.8)], "d date, inv long, scale double")
    adj = ix.seasonal_adjusted(F.col("inv"), iso_week(F.col("d")), F.col("scale"))
    model = ix.seasonal_model(F.month("d"))
    diff = ix.seasonal_difference(adj, model)
    r = df.select(adj.alias("a"), diff.alias("f"), ix.seasonal_index(diff).alias("i")).first()
    assert math.isclose(r.a, 0.9069767349284342, rel_tol=1e-9)
    assert math.isclose(r.f, 0.029485510701968476, rel_tol=1e-7)
    assert math.isclose(r.i, 97.13589842737433, rel_tol=1e-9)


def test_composite_change_is_mean_of_differences(spark):
    # a published week-over-week report: composite = mean of the six differences
    diffs = [-3.1590842711103377, -17.26013847181008, 23.0281051747028, 10.723673159061562,
             -1.471428571428575, -4.022857142857141]
    assert math.isclose(sum(diffs) / 6, 1.3063783127596906, rel_tol=1e-12)


def test_baseline_wrap_golden(spark):
    from tidemark.operators.baseline import centred_circular
    # published baseline: weeks 52, 1, 2 -> baseline of week 1 = 10110
    sats = {1: dt.date(2019, 1, 5), 2: dt.date(2019, 1, 12), 52: dt.date(2019, 12, 28)}
    vals = {1: 16110, 2: 8300, 52: 5920}
    df = spark.createDataFrame([(sats[w], vals[w]) for w in sats], "week_end date, n long")
    b = {r.iso_week: r.base for r in centred_circular(df, 2019).collect()}
    assert b[1] == 10110.0


def test_landed_baselines_golden(spark, tmp_path):
    import pytest
    from tidemark.operators.baseline import landed_baseline
    from tidemark.sources.csv_io import read_typed_csv, schema_from_codes
    # the claims file: dates on real weeks, a week 53 without a date, blank lines
    path = tmp_path / "claims.csv"
    path.write_text("date_2019,isoweek,total,avg\n2019-01-05,1,16110,10110\n2019-12-28,52,5920,9063.333333\n,53,,11155\n" + ",,,\n" * 107)
    claims = read_typed_csv(spark, str(path), schema_from_codes(["date_2019", "isoweek", "total", "avg"], "Diid"))
    assert sorted(map(tuple, landed_baseline(claims, "isoweek", "avg").collect())) == [(1, 10110.0), (52, 9063.333333), (53, 11155.0)]
    assert {r.iso_week: r.base for r in landed_baseline(claims.where("isoweek < 53"), "isoweek", "avg").collect()}[53] == (9063.333333 + 10110) / 2
    # the area file (byte order mark): the city's week 53 is stated, the areas' follow the rule
    path = tmp_path / "areas.csv"
    path.write_text("\ufeffisoweek,city,man,bk,qn\n1,249.6666667,115.3,78.7,40\n52,271.75,138,86.7,43.7\n53,224.5,,,\n")
    areas = read_typed_csv(spark, str(path), schema_from_codes(["isoweek", "city", "man", "bk", "qn"], "idddd"))
    got = {(r.area, r.iso_week): r.base for r in landed_baseline(areas, "isoweek", {c: c for c in ("city", "man", "bk", "qn")}).collect()}
    assert len(got) == 12
    for area, base in {"city": 224.5, "man": 126.65, "bk": 82.7, "qn": 41.85}.items():
        assert math.isclose(got[area, 53], base, rel_tol=1e-12)
    # the same week twice is one week, unless the values differ
    assert landed_baseline(claims.unionByName(claims), "isoweek", "avg").count() == 3
    assert landed_baseline(claims.limit(0), "isoweek", "avg").count() == 0
    with pytest.raises(Exception, match="baseline week 1 has two values"):
        landed_baseline(claims.unionByName(claims.withColumn("avg", F.lit(1.0))), "isoweek", "avg").orderBy("iso_week").collect()
