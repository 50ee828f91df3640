"""Rolling means over one long series without keys, in parallel.

An ordered window without a partition key is one task. Here the rows are put in order by
ranges, each range gets the k - 1 rows that border it (from as many neighbours as it takes), and
the window runs inside the ranges. What passes between ranges is k - 1 rows a range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.windows import rollmean
from tidemark.session import scratch_path

AT, PART, POS, START, LAST, HALO = "_range_at", "_range", "_range_pos", "_range_start", "_range_last", "_range_halo"


def in_ranges(df: DataFrame, order_by: Sequence[str], ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``df`` in order by ranges with each row's range and position in the whole, and the ranges (number,
    first and last position). The ordered rows are written to the shared folder, so numbering reads
    them as they are; the ranges are one row each and come over the driver."""
    spark = df.sparkSession
    taken = {c.lower() for c in df.columns} & {AT, PART, POS, START, LAST, HALO}
    if taken:
        raise ValueError(f"columns {sorted(taken)} are needed here; rename them")
    path = scratch_path(spark, "ranges")
    dealt = df.repartitionByRange(ranges, *order_by) if ranges else df.repartitionByRange(*order_by)
    dealt.sortWithinPartitions(*order_by).withColumn(AT, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn(PART, F.shiftright(AT, 33))
    table, start = [], 0
    for r in sorted(rows.groupBy(PART).agg(F.min(AT).alias("first"), F.count("*").alias("n")).collect()):
        table.append((r[PART], r["first"], start, start + r["n"] - 1))
        start += r["n"]
    bounds = spark.createDataFrame(table, f"{PART} bigint, first bigint, {START} bigint, {LAST} bigint")
    rows = rows.join(bounds, PART).withColumn(POS, F.col(AT) - F.col("first") + F.col(START)).drop(AT, "first")
    return rows, bounds.drop("first")


def rollmean_ranged(df: DataFrame, x: str, k: int, order_by: Sequence[str], out: str, align: str = "right",
                    ranges: int | None = None) -> DataFrame:
    """``df`` with ``out``, the mean of k consecutive rows of the whole table in the given order, by the
    rules of ``operators.windows.rollmean``. The order should be total; rows that tie in it
    stand in any order."""
    rows, bounds = in_ranges(df, order_by, ranges)
    if align == "right":     # the last rows before a range stand before it
        edge = F.col(LAST) - F.col(POS) < k - 1
        wanted, at = F.sequence(F.col(POS) + 1, F.col(POS) + (k - 1)), START
    elif align == "left":    # the first rows after a range stand behind it
        edge = F.col(POS) - F.col(START) < k - 1
        wanted, at = F.sequence(F.col(POS) - (k - 1), F.col(POS) - 1), LAST
    else:
        raise ValueError(f"align must be 'right' or 'left', not {align!r}")
    rows = rows.withColumn(HALO, F.lit(False))
    if k > 1:
        target = bounds.select(F.col(PART).alias("_target"), F.col(at).alias("_near"))
        halo = rows.where(edge).withColumn("_near", F.explode(wanted)).join(target, "_near").where(F.col("_target") != F.col(PART))
        rows = rows.unionByName(halo.drop(PART, "_near").withColumnRenamed("_target", PART).withColumn(HALO, F.lit(True)))
    mean = rows.withColumn(out, rollmean(x, k, POS, [PART], align))
    return mean.where(~F.col(HALO)).select(*df.columns, out)
