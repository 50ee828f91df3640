"""Seasonal baselines keyed by ISO week.

The baseline of week w is the mean of the baseline year's weeks w-1, w, w+1,
wrapping around the year (week 1 uses the last week, the last week uses
week 1). A year with 52 ISO weeks gets a week 53 equal to the mean of its
last week and week 1, so weeks 53 of later years still find a baseline. A week
whose three neighbours are not all there has a NULL baseline.

Baselines can also be landed as files (``landed_baseline``): a week-53 value that a file states
stands, a missing one follows the rule, and ``with_stated`` puts stated weeks over computed ones.

Implementation: every weekly row is sent to the three weeks it contributes
to (explode of a 3-element array) and summed per target week. This is a
grouped aggregation, not an unpartitioned window, so it partitions by the
series keys and scales with the number of series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import iso_week, iso_year


def weeks_in_iso_year(year_col):
    """52 or 53: the ISO week of 28 December."""
    return F.weekofyear(F.make_date(year_col, F.lit(12), F.lit(28)))


def centred_circular(weekly: DataFrame, base_year: int, date_col: str = "week_end",
                     value_col: str = "n", keys: Sequence[str] = (),
                     week53_rule: bool = True, out: str = "base") -> DataFrame:
    """(keys, iso_week, base) from a weekly series with integral values."""
    yr = (weekly.where(iso_year(F.col(date_col)) == base_year)
          .select(*keys, iso_week(F.col(date_col)).alias("w"), F.col(value_col).alias("v"),
                  weeks_in_iso_year(F.lit(base_year)).alias("nw")))
    spread = yr.select(*keys, "v", "nw", F.explode(F.array(
        ((F.col("w") - 2 + F.col("nw")) % F.col("nw")) + 1,
        F.col("w"),
        (F.col("w") % F.col("nw")) + 1)).alias("iso_week"))
    base = (spread.groupBy(*keys, "iso_week")
            .agg(F.when(F.count("v") == 3, F.sum("v").cast("double") / F.lit(3.0)).alias(out), F.max("nw").alias("nw")))
    if not week53_rule:
        return base.drop("nw")
    return base.drop("nw").unionByName(_week53(base.where(F.col("nw") == 52), keys, out))


def _week53(base: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """The row of week 53 by the rule: the mean of weeks 52 and 1, where both are there."""
    return (base.where(F.col("iso_week").isin(52, 1)).groupBy(*keys)
            .agg(F.count("*").alias("c"), (F.sum(out) / F.lit(2.0)).alias(out))
            .where(F.col("c") == 2).select(*keys, F.lit(53).alias("iso_week"), out))


def landed_baseline(landed: DataFrame, week_col: str, value_cols: dict[str, str] | str, key: str = "area",
                    out: str = "base") -> DataFrame:
    """(iso_week, base) of a landed baseline file, or (key, iso_week, base) of one with a column per area
    (``value_cols``: area -> column). Rows without a week are blank lines at the end and go; a week without
    a value is taken as not stated; a week stated twice with different values raises when it is read. An
    area whose file has no week 53 gets it by the rule."""
    rows = landed.where(F.col(week_col).isNotNull()).withColumn("iso_week", F.col(week_col).cast("int"))
    if isinstance(value_cols, str):
        keys, long = [], rows.select("iso_week", F.col(value_cols).cast("double").alias(out))
    else:
        keys = [key]
        pairs = F.array(*[F.struct(F.lit(a).alias(key), F.col(c).cast("double").alias(out)) for a, c in value_cols.items()])
        long = rows.select("iso_week", F.inline(pairs))
    long = (long.where(F.col(out).isNotNull()).groupBy(*keys, "iso_week")
            .agg(F.min(out).alias(out), F.max(out).alias("most")))
    clash = F.raise_error(F.concat(F.lit("baseline week "), F.col("iso_week").cast("string"), F.lit(" has two values"))).cast("double")
    long = long.select(*keys, "iso_week", F.when(F.col(out) == F.col("most"), F.col(out)).otherwise(clash).alias(out))
    return with_stated(_week53(long, keys, out), long, keys, out)


def with_stated(computed: DataFrame, stated: DataFrame, keys: Sequence[str] = (), out: str = "base") -> DataFrame:
    """Both baselines' weeks; where both have a week, the stated value. A stated NULL states nothing."""
    both = (computed.select(*keys, "iso_week", F.lit(0).alias("stated"), out)
            .unionByName(stated.where(F.col(out).isNotNull()).select(*keys, "iso_week", F.lit(1).alias("stated"), out)))
    return both.groupBy(*keys, "iso_week").agg(F.max_by(out, "stated").alias(out))


def join_baseline(series: DataFrame, base: DataFrame, how: str = "left",
                  keys: Sequence[str] = (), date_col: str = "week_end") -> DataFrame:
    """Attach the baseline by (keys, ISO week of the series date).

    The baseline has 53 rows per key; Spark picks the join from its size. Rows with a NULL week key are dropped from
    the baseline first (blank trailing rows in landed files)."""
    s = series.withColumn("iso_week", iso_week(F.col(date_col)))
    b = base.where(F.col("iso_week").isNotNull())
    return s.join(b, [*keys, "iso_week"], how)
