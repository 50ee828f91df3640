"""The six index formulas, as Column expressions.

Each returns the uncapped value; ``cap`` gives the published value. Constants
are plain doubles and every expression is written in the reference's order of
operations, so results are reproducible bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalar import cap, ratio

# Fixed values (must equal the reference's rental seasonal model):
# month -> 10-year median model, January .. December.
SEASONAL_MODEL = {
    1: 0.9891, 2: 0.9811, 3: 1.0659, 4: 1.0775, 5: 1.1359, 6: 1.1893,
    7: 1.2042, 8: 1.1728, 9: 1.0496, 10: 1.0406, 11: 0.9774, 12: 0.8810,
}
# Fixed values of the rental trend adjustment: yearly growth factor and
# weeks per year used to spread it.
SEASONAL_GROWTH = 1.11108297
SEASONAL_WEEKS = 52.28571429
# Fixed value of the hospitalisation index: log10 scale divisor.
LOG_SCALE = 3.5


def ratio_index(x: Column, base: Column) -> Column:
    """Direct ratio (home sales): x / base * 100."""
    return ratio(x, base) * F.lit(100.0)


def inverse_index(x: Column, base: Column) -> Column:
    """Inverse ratio (claims): p = (x - base)/base; 100/((100 p) + 100)*100.
    No claims against a positive base give Infinity, claims against none 0."""
    p = ratio(x - base, base)
    return ratio(F.lit(100.0), F.lit(100.0) * p + F.lit(100.0)) * F.lit(100.0)


def inverse_index_capped(x: Column, base: Column) -> Column:
    """Capped claims index: zero claims against a positive base cap to 100; 0 against 0 is NULL."""
    return cap(inverse_index(x, base))


def shift_index(mean_pct: Column) -> Column:
    """Restaurants: mean7 of YoY percent change + 100."""
    return mean_pct + F.lit(100.0)


def comparable_index(mean_frac_minus_one: Column) -> Column:
    """Subway: (1 + mean7(fraction of comparable day - 1)) * 100."""
    return (F.lit(1.0) + mean_frac_minus_one) * F.lit(100.0)


def log_index(mean7: Column) -> Column:
    """Hospitalisations: (1 - log10(mean7 + 1) / 3.5) * 100 (may go negative)."""
    return (F.lit(1.0) - F.log10(mean7 + F.lit(1.0)) / F.lit(LOG_SCALE)) * F.lit(100.0)


def seasonal_model(month: Column) -> Column:
    """Month -> model constant, as a literal map look-up (JVM-side)."""
    m = F.create_map(*[x for k, v in SEASONAL_MODEL.items() for x in (F.lit(k), F.lit(float(v)))])
    return m[month]


def seasonal_adjusted(inv: Column, week: Column, scale: Column) -> Column:
    """Inventory adjusted for the in-year trend, relative to ``scale``."""
    growth = F.lit(SEASONAL_GROWTH) - F.lit(1.0)
    return ratio(inv - inv * growth * week / F.lit(SEASONAL_WEEKS), scale)


def seasonal_difference(adjusted: Column, model: Column) -> Column:
    """Distance from the model: abs(adjusted / model - 1)."""
    return F.abs(ratio(adjusted, model) - F.lit(1.0))


def seasonal_index(difference: Column) -> Column:
    """Rentals: 100 / (difference + 1)."""
    return F.lit(100.0) / (difference + F.lit(1.0))
