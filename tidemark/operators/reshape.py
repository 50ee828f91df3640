"""Long <-> wide and shares of a group total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import clean_name, round_ratio_half_even


def to_long(df: DataFrame, ids: Sequence[str], var: str, val: str,
            cols: Sequence[str] | None = None) -> DataFrame:
    """Wide -> long over every non-id column (the column list is read from
    the schema, so a matrix that grows a column per week needs no code
    change). NULL cells are kept."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in ids]
    return df.unpivot(list(ids), cols, var, val)


MAX_COLUMNS = 2000


def to_wide(df: DataFrame, ids: Sequence[str], key: str, value: str,
            values: Sequence | None = None, prefix: str = "", suffix: str = "", max_columns: int = MAX_COLUMNS) -> DataFrame:
    """Long -> wide, one column per key, named ``clean_name(prefix + key + suffix)``.

    ``values`` lists the keys where the list is the feature; without it every key of
    the data becomes a column (NULL first, then sorted). The keys are read in one small job, so
    ``df`` should be an aggregate; more than ``max_columns`` of them raise ValueError. A NULL
    key has the column ``_null`` (after a prefix ``<prefix>__null``), a name that no
    other key can get. Keys whose cleaned names are equal get ``_2``, ``_3``, ... Missing
    cells are NULL. Each (ids, key) has one row, so ``max`` is the deterministic pick."""
    if values is None:
        found = df.select(F.col(key).cast("string")).distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"{key} has more than {max_columns} different values; each would be a column")
        values = sorted((r[0] for r in found), key=lambda v: (v is not None, v or ""))
        df = df.withColumn(key, F.col(key).cast("string"))
    names = wide_names(values, prefix, suffix)
    cells = [F.max(F.when(F.col(key).eqNullSafe(F.lit(v)), F.col(value))).alias(n) for v, n in zip(values, names)]
    return df.groupBy(*ids).agg(*cells) if cells else df.select(*ids).distinct()


def wide_names(values: Sequence[str | None], prefix: str = "", suffix: str = "") -> list[str]:
    """Computed column names for pivoted keys (clean snake_case, made distinct)."""
    out: list[str] = []
    for v in values:
        if v is None:   # cleaned names neither start with an underscore nor hold two in a row
            out.append((clean_name(prefix) + "_" if prefix else "") + "_null" + suffix)
            continue
        base = name = clean_name(f"{prefix}{v}{suffix}")
        k = 1
        while name in out:
            k += 1
            name = f"{base}_{k}"
        out.append(name)
    return out


def share_of_total(df: DataFrame, group: Sequence[str], value: str, out: str = "share",
                   scale: int = 2) -> DataFrame:
    """value / sum(value) over the group * 100, rounded half-even; the group
    total is a window sum over rows already at (group, part) grain."""
    total = F.sum(F.col(value)).over(Window.partitionBy(*group))
    return (df.withColumn("_total", total)
            .withColumn(out, round_ratio_half_even(F.col(value), F.col("_total"), scale, mult=100))
            .drop(value, "_total"))


def union_tagged(parts: dict[str, DataFrame], tag: str = "area") -> DataFrame:
    """One table per source, tagged and unioned by name (missing columns
    NULL-filled)."""
    out = None
    for name, df in parts.items():
        df = df.withColumn(tag, F.lit(name))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out
