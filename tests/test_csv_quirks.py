"""Landed-file quirks the CSV readers must survive."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F

from tidemark.functions.scalar import clean_name, to_int_trunc
from tidemark.sources.csv_io import read_text_csv, read_typed_csv, schema_from_codes


def _land(text: str, newline: str = "\n", bom: bool = False) -> str:
    d = tempfile.mkdtemp(prefix="tidemark-csv-")
    p = os.path.join(d, "f.csv")
    with open(p, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as fh:
        fh.write(text.replace("\n", newline))
    return p


def test_bom_crlf_na_and_blank_rows(spark):
    p = _land("date_2019,isoweek,total,avg\n2019-01-05,1,16110,10110.0\n2019-01-12,2,NA,8300.5\n,,,\n,,,\n",
              newline="\r\n", bom=True)
    df = read_typed_csv(spark, p, schema_from_codes(["date_2019", "isoweek", "total", "avg"], "Diid"))
    rows = df.collect()
    assert df.columns == ["date_2019", "isoweek", "total", "avg"]     # BOM stripped from the header
    assert rows[0] == (dt.date(2019, 1, 5), 1, 16110, 10110.0)
    assert rows[1].total is None                                       # NA token -> NULL
    # trailing all-empty rows arrive as all-NULL rows; drop null keys before joining
    assert df.where(F.col("isoweek").isNotNull()).count() == 2


def test_quoted_header_with_embedded_newline(spark):
    p = _land('Region,Month,"Community & Social Service\n",Sales\nNew York City,2019-01-01,1.5,NA\n')
    df = read_text_csv(spark, p, multi_line=True)
    assert df.count() == 1
    assert [clean_name(c) for c in df.columns] == ["region", "month", "community_social_service", "sales"]


def test_untyped_read_then_cast(spark):
    p = _land("date,n\n2022-12-03,12.7\n2022-11-26,junk\n")
    df = read_text_csv(spark, p)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == {"date": "string", "n": "string"}
    out = df.select(F.try_to_date("date").alias("d"), to_int_trunc(F.col("n")).alias("n")).collect()
    assert out == [(dt.date(2022, 12, 3), 12), (dt.date(2022, 11, 26), None)]


def test_matrix_with_title_row_then_melt(spark):
    from tidemark.operators.reshape import to_long
    from tidemark.sources.csv_io import read_matrix_csv
    p = _land("Weekly Initial Claims by County,,,\n"
              "Region,County,\"January 5, 2019\",\"January 12, 2019\"\n"
              "New York City,Bronx,1200,NA\n"
              "New York City,Kings,2100,2300\n"
              ",,,\n")
    wide = read_matrix_csv(spark, p, "Region")
    assert wide.columns == ["Region", "County", "January 5, 2019", "January 12, 2019"]
    assert wide.count() == 3        # the row of empty cells stays
    wide = wide.where("County IS NOT NULL")
    long = to_long(wide, ["Region", "County"], "date", "claims")
    out = long.select("County", F.try_to_date("date", "MMMM d, yyyy").alias("d"),
                      to_int_trunc(F.col("claims")).alias("n")).collect()
    got = sorted((r.County, r.d, r.n) for r in out)
    assert got == [("Bronx", dt.date(2019, 1, 5), 1200), ("Bronx", dt.date(2019, 1, 12), None),
                   ("Kings", dt.date(2019, 1, 5), 2100), ("Kings", dt.date(2019, 1, 12), 2300)]


def test_matrix_unpadded_title_and_missing_header(spark):
    import pytest
    from tidemark.sources.csv_io import read_matrix_csv
    p = _land("Claims\nRegion,w1,w2\nA,1,2\nB,,\nC,5,6\n")
    rows = [tuple(r) for r in read_matrix_csv(spark, p, "Region").collect()]
    assert rows == [("A", "1", "2"), ("B", None, None), ("C", "5", "6")]
    with pytest.raises(ValueError):
        read_matrix_csv(spark, p, "Nowhere")
    with pytest.raises(ValueError):
        read_matrix_csv(spark, _land("Title\nRegion\nA\n"), "Region")


def test_large_csv_is_split(spark):
    p = _land("d,n\n" + "2020-01-01,1\n" * 200_000)
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, str(1 << 18))
    try:
        assert read_typed_csv(spark, p, "d DATE, n INT").rdd.getNumPartitions() > 1
    finally:
        spark.conf.set(key, old)


def test_payload_of_the_right_script(spark):
    from tidemark.plans.q_misc import embedded_payload
    pages = [(1, "<script>a()</script><script>\n  track(42)</script>"), (2, "track(7) <script>x</script>"),
             (3, "<script>track()</script>"), (4, "<p>none</p>")]
    t = type("T", (), {"pages": spark.createDataFrame(pages, "page_id long, html string")})()
    got = {r.page_id: r.payload for r in embedded_payload(t).collect()}
    assert got == {1: 42, 2: None, 3: None}
