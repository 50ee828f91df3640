"""Tables laid down by day, read by bounds that their folder names state.

The newest day is known from the names of the files, without opening one; the days asked for
become a literal predicate on the partition column, so the scan lists and opens only their folders.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.listing import newest_dated

DAY = "day"


def write_days(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """Write ``df`` below ``day=YYYY-MM-DD`` folders. Rows are dealt by day in pieces of the advisory
    size: small days share a task, a day that holds much of the data is cut."""
    (df.withColumn(DAY, F.to_date(ts)).hint("rebalance", DAY)
     .write.mode(mode).partitionBy(DAY).parquet(path))


def newest_day(spark: SparkSession, path: str) -> dt.date | None:
    """The newest day that has a file."""
    return newest_dated(spark, path, before=f"{DAY}=", after="/").first()["latest"]


def recent_days(spark: SparkSession, path: str, days: int) -> DataFrame:
    """The rows of the last ``days`` days up to the newest one; no other folder is read."""
    newest = newest_day(spark, path)
    table = spark.read.parquet(path)
    if newest is None:
        return table.where(F.lit(False))
    return table.where(F.col(DAY) > F.lit(newest - dt.timedelta(days=days)))
