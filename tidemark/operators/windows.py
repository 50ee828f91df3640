"""Row-based rolling means, first differences and horizon look-ups.

The rolling mean is the reference's ``rollmean(x, k, fill=NA)``: a frame of
k *rows* (source dates have holes), NULL until k rows exist and NULL when any
value in the frame is NULL. It is written as an explicit sum of k lagged
values so the additions happen in a fixed order. Windows run after
aggregation to (series, day) grain and are partitioned by the series keys;
a single series (no keys) holds one row per day, a few thousand rows at any
data size, so even its one-partition window stays small.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import pct_chg


def _window(order_by, partition_by):
    order = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    return Window.partitionBy(*partition_by).orderBy(*order)


def rollmean(x: str | Column, k: int = 7, order_by="d",
             partition_by: Sequence[str] = (), align: str = "right") -> Column:
    """Mean of k consecutive rows.

    ``align='right'``: rows t-k+1..t (trailing, NULL for the first k-1 rows).
    ``align='left'``: rows t..t+k-1 (leading, NULL for the last k-1 rows).
    Integral inputs are summed exactly before the single division.
    """
    x = F.col(x) if isinstance(x, str) else x
    w = _window(order_by, partition_by)
    if align == "right":
        terms = [F.lag(x, i).over(w) for i in range(k - 1, 0, -1)] + [x]
    elif align == "left":
        terms = [x] + [F.lead(x, i).over(w) for i in range(1, k)]
    else:
        raise ValueError(f"align must be 'right' or 'left', not {align!r}")
    total = reduce(lambda a, b: a + b, terms)
    return total.cast("double") / F.lit(float(k))


def diff(x: str | Column, order_by="d", partition_by: Sequence[str] = ()) -> Column:
    """x - previous row's x (R ``diff``)."""
    x = F.col(x) if isinstance(x, str) else x
    return x - F.lag(x, 1).over(_window(order_by, partition_by))


def horizon_change(series: DataFrame, keys: Sequence[str], date_col: str,
                   value_col: str, horizons: Sequence[tuple[str, int | Column]]) -> DataFrame:
    """Percent change of each series' latest value against the value
    ``days_back`` days earlier, for every (series, horizon).

    ``horizons`` is a list of ``(name, days_back)``; ``days_back`` may be a
    Column over ``mx`` (the series' latest date), e.g. whole years since the
    base year. Horizons are attached by exploding a literal array (no join),
    and the look-up of the old value is an equi-join on (keys, date). When
    the old date is missing the latest value is compared with itself
    (change 0), as the reference does; an old row without a value gives NULL.
    """
    latest = series.groupBy(*keys).agg(F.max(date_col).alias("mx"))
    cur = (latest.join(series.withColumnRenamed(date_col, "mx"), [*keys, "mx"])
           .withColumnRenamed(value_col, "new"))
    hz = F.array(*[F.struct(F.lit(name).alias("change"),
                            (back if isinstance(back, Column) else F.lit(back)).cast("int").alias("days_back"))
                   for name, back in horizons])
    wanted = (cur.select(*keys, "mx", "new", F.explode(hz).alias("h"))
              .select(*keys, "mx", "new", "h.change",
                      F.date_sub(F.col("mx"), F.col("h.days_back")).alias("old_date")))
    old = series.select(*keys, F.col(date_col).alias("old_date"), F.col(value_col).alias("old"), F.lit(True).alias("found"))
    out = wanted.join(old, [*keys, "old_date"], "left")
    old_v = F.when(F.col("found"), F.col("old")).otherwise(F.col("new"))
    return out.select("change", *keys, pct_chg(F.col("new"), old_v).alias("chg"))
