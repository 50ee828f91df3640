"""Scalar helpers shared by the index operators.

The index arithmetic is plain IEEE double arithmetic written in a fixed
order, so a second engine evaluating the same expression gets the same bits.
Where the reference rounds (percent changes, shares) we round the exact
rational value half-to-even with integer arithmetic instead of rounding a
double, which removes any dependence on binary representation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(x: Column) -> Column:
    """NaN -> NULL. Spark orders NaN above every number, so a NaN would
    otherwise be capped to 100; the reference yields NA instead."""
    return F.nanvl(x, F.lit(None).cast("double"))


def cap(x: Column, limit: float = 100.0) -> Column:
    """``if_else(x > limit, limit, x)``: NULL stays NULL (unlike ``least``)."""
    x = nan_to_null(x)
    return F.when(x > F.lit(float(limit)), F.lit(float(limit))).otherwise(x)


def ratio(num: Column, den: Column) -> Column:
    """num / den as DOUBLE with IEEE rules for a zero base, in ANSI mode too: a
    positive number over 0 is Infinity (``cap`` makes it the limit), a negative
    one -Infinity, 0 over 0 NULL. NULL stays NULL. The one rule of every index."""
    num, den = num.cast("double"), den.cast("double")
    inf = F.lit(float("inf"))
    return (F.when(den != 0, F.try_divide(num, den))
            .when((den == 0) & (num > 0), inf).when((den == 0) & (num < 0), -inf))


def round_ratio_half_even(num: Column, den: Column, scale: int = 2,
                          mult: int = 1) -> Column:
    """round(num * mult / den, scale) half-to-even, exactly, for integral
    num/den (any BIGINT); NULL when den is 0. Returned as DOUBLE (= q / 10^scale).
    All steps on 38-digit decimals: none goes through a double."""
    p = 10 ** scale
    a = (F.abs(num.cast("decimal(20,0)")) * F.lit(mult * p).cast("decimal(10,0)")).cast("decimal(38,0)")
    b = F.nullif(F.abs(den.cast("decimal(20,0)")), F.lit(0).cast("decimal(20,0)"))
    r = a % b
    q = ((a - r) / b).cast("decimal(38,0)")  # a whole number: the decimal division is exact
    q = (F.when(r * 2 > b, q + 1)
         .when(r * 2 == b, q + q % 2)
         .otherwise(q))
    neg = (num < 0) != (den < 0)
    signed = F.when(neg & (num != 0), -q).otherwise(q)
    return F.when(den != 0, signed.cast("double") / F.lit(float(p)))


def pct_chg(new: Column, old: Column) -> Column:
    """round((new - old) / old * 100, 2), exact half-even for counts."""
    return round_ratio_half_even(new - old, old, scale=2, mult=100)


def to_double(s: Column) -> Column:
    """``as.double``: text to DOUBLE, junk -> NULL."""
    return s.try_cast("double")


def to_int_trunc(s: Column) -> Column:
    """``as.integer``: text to INT truncating toward zero, junk -> NULL.
    ``try_cast('12.7' as int)`` alone is NULL, so go through DOUBLE."""
    return s.try_cast("double").try_cast("int")


def slug(s: Column) -> Column:
    """Lower-case, runs of whitespace -> ``_``."""
    return F.regexp_replace(F.lower(s), r"\s+", "_")


_NON_ALNUM = re.compile(r"[^0-9a-zA-Z]+")


def clean_name(name: str) -> str:
    """snake_case a column name (driver-side metadata, not data):
    non-alphanumerics become ``_``, lower-case, and a leading digit gets an
    ``x`` prefix so the result is a valid identifier."""
    out = _NON_ALNUM.sub("_", name.strip()).strip("_").lower()
    out = re.sub(r"_+", "_", out)
    if not out:
        out = "x"
    if out[0].isdigit():
        out = "x" + out
    return out
