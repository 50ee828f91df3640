"""Composite index: scores, history append, week-over-week report, readiness.

All inputs are at (date) grain - one row per week - so these operators are
small joins and projections; nothing here touches raw facts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import cap

PARTS = 6.0   # six measures, each worth 100/6 of the composite


def scores(df: DataFrame, measures: Sequence[str], parts: float = PARTS,
           date_col: str = "date") -> DataFrame:
    """Each measure / parts (max 16 2/3 each)."""
    return df.select(date_col, *[(F.col(m) / F.lit(parts)).alias(m) for m in measures])


def horizontal_sum(cols: Sequence[Column]) -> Column:
    """c1 + c2 + ... left to right (NULL if any is NULL)."""
    return reduce(lambda a, b: a + b, cols)


def composite(df: DataFrame, measures: Sequence[str], out: str = "composite_index",
              parts: float = PARTS) -> DataFrame:
    """Scores plus their sum, the composite out of 100."""
    s = scores(df, measures, parts)
    return s.withColumn(out, horizontal_sum([F.col(m) for m in measures]))


def newer_than(df: DataFrame, date_col: str, newest: Column) -> DataFrame:
    """Rows after ``newest``; all of them when it is NULL (an empty history)."""
    return df.where(newest.isNull() | (F.col(date_col) > newest))


def append_newer(history: DataFrame, new: DataFrame, date_col: str, upto: Column | None = None) -> DataFrame:
    """Keep history as published; add only rows newer than its max date
    (and not after ``upto``). Union by name, missing columns NULL. An empty
    history takes every row (its max is NULL)."""
    new = newer_than(new, date_col, history.agg(F.max(date_col)).scalar())
    if upto is not None:
        new = new.where(F.col(date_col) <= upto)
    return history.unionByName(new, allowMissingColumns=True)


def week_over_week(df: DataFrame, measures: Sequence[str], week: Column,
                   out: str = "composite_index", date_col: str = "date") -> DataFrame:
    """Long report (analysis_week, measure, change): each measure's change
    from the previous week, and the composite change = sum(this/6) - sum(prev/6).
    The previous week is found by an equi-join on date - 7."""
    this = df.where(F.col(date_col) == week)
    prev = df.select(F.date_add(F.col(date_col), 7).alias(date_col),
                     *[F.col(m).alias(f"{m}__prev") for m in measures])
    j = this.join(prev, date_col, "inner")
    comp = (horizontal_sum([F.col(m) / F.lit(PARTS) for m in measures])
            - horizontal_sum([F.col(f"{m}__prev") / F.lit(PARTS) for m in measures]))
    wide = j.select(F.col(date_col).alias("analysis_week"), comp.alias(out),
                    *[(F.col(m) - F.col(f"{m}__prev")).alias(m) for m in measures])
    return wide.unpivot(["analysis_week"], [out, *measures], "measure", "change")


def cap_scores(df: DataFrame, measures: Sequence[str], limit: float = 100.0 / PARTS,
               date_col: str = "date") -> DataFrame:
    """Restate history with each score capped at 100/6 (NULL stays NULL)."""
    return df.select(date_col, *[cap(F.col(m), limit).alias(m) for m in measures])


def readiness(frames: dict[str, DataFrame], weeks: DataFrame, date_col: str = "date") -> DataFrame:
    """(feed, week, present, run_ready, any_missing): which feeds have a
    non-null value for each expected week; ``run_ready`` is true only if all
    are present, ``any_missing`` is its complement (the gate's bool-any).
    ``frames`` map feed name -> (date, value); ``weeks`` lists the weeks.

    Expected and actual rows are unioned and grouped once, each feed cut to the
    expected weeks first; the gate is a window over feeds x weeks rows."""
    names = F.array(*[F.lit(n) for n in frames])
    rows = weeks.select(F.explode(names).alias("feed"), F.col(date_col), F.lit(True).alias("due"), F.lit(False).alias("hit"))
    first, last = weeks.agg(F.min(date_col)).scalar(), weeks.agg(F.max(date_col)).scalar()
    for name, f in frames.items():
        v = f.where(F.col("value").isNotNull() & F.col(date_col).between(first, last))
        rows = rows.unionByName(v.select(F.lit(name).alias("feed"), date_col, F.lit(False).alias("due"), F.lit(True).alias("hit")))
    status = (rows.groupBy("feed", F.col(date_col).alias("week"))
              .agg(F.bool_or("due").alias("due"), F.bool_or("hit").alias("present")).where("due").drop("due"))
    every = Window.partitionBy(F.lit(1))
    return (status.withColumn("run_ready", F.bool_and("present").over(every))
            .withColumn("any_missing", F.bool_or(~F.col("present")).over(every)))
