"""Join helpers. No hints: Spark and AQE choose the strategy from real sizes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def chain_inner(frames: Sequence[DataFrame], on: str | Sequence[str]) -> DataFrame:
    """Inner-join a list of tables on a shared key (any missing key drops
    the row). Each input is at (date) grain, so AQE broadcasts them."""
    return reduce(lambda a, b: a.join(b, on, "inner"), frames)


def broadcast_threshold(spark) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 = never)."""
    v = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    for suffix in ("kb", "mb", "gb", "tb", "k", "m", "g", "t", "b"):
        if v.endswith(suffix):
            num = v[: -len(suffix)]
            return int(float(num) * units.get(suffix[0], 1))
    return int(v)


def join_dimension(facts: DataFrame, dim: DataFrame, on: str, dim_bytes: int, pre_aggregate) -> DataFrame:
    """Join facts to a dimension; Spark and AQE choose the join from real sizes.

    Where the dimension's files exceed the broadcast threshold the join will
    shuffle, so the facts are first reduced with ``pre_aggregate`` (a map-side
    partial aggregate on the join key and the output grain): a key with a third of
    all rows arrives as a few rows per task. Below it the facts need no shuffle for
    the join, and the aggregate would only add one. Both ways give the same rows.
    """
    if dim_bytes > broadcast_threshold(facts.sparkSession):
        facts = pre_aggregate(facts)
    return facts.join(dim, on)
