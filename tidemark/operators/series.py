"""Raw facts -> (series keys, period) grain.

This is the one step that touches every input row, so it is written to stay
cheap at scale: only the needed columns are read (column pruning reaches the
parquet scan), and every grouping is a partial (map-side) aggregation, so a
hot key contributes one partial row per task instead of its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import week_ending_saturday


def money(c) -> Column:
    """Money as DECIMAL(18,2) so sums are exact (no float summation order)."""
    return F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")


def decimal_to_double(c: Column) -> Column:
    """Exact decimal sum -> DOUBLE, narrowed to 18 digits first so the
    conversion is a single correctly rounded division."""
    return c.cast("decimal(18,2)").cast("double")


def whole(total: Column) -> Column:
    """An exact decimal sum of quantities as BIGINT, rounded once; a sum of nothing is 0."""
    return F.coalesce(F.round(total, 0), F.lit(0)).cast("long")


def daily_to_weekly(daily: DataFrame, date_col: str, keys: Sequence[str],
                    sums: Sequence[str], out: str = "week_end") -> DataFrame:
    """Roll a day-grain table up to Saturday-ending weeks by summing; NULLs add nothing,
    so a week of NULLs is 0."""
    return (daily.withColumn(out, week_ending_saturday(F.col(date_col)))
            .groupBy(*keys, out)
            .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums]))


def date_spine(bounds: DataFrame, lo: str = "lo", hi: str = "hi",
               keys: Sequence[str] = (), out: str = "d") -> DataFrame:
    """One row per calendar day in [lo, hi] (per key). The spine grows with
    the calendar span, not with the data."""
    return bounds.select(*keys, F.explode(F.sequence(F.col(lo), F.col(hi))).alias(out))


def zero_fill_daily(daily: DataFrame, date_col: str, counts: Sequence[str],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Left-join a day-grain count table onto a dense day spine from its own
    min to max date and fill missing counts with 0 (a day without events is
    a real zero). Only for count feeds: ratios must stay sparse."""
    bounds = daily.groupBy(*keys).agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    spine = date_spine(bounds, keys=keys, out=date_col)
    filled = spine.join(daily, [*keys, date_col], "left")
    return filled.select(*keys, date_col,
                         *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in counts])
