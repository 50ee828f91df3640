"""Column functions: every helper returns a ``Column`` built from
``pyspark.sql.functions``, so it stays inside whole-stage codegen."""

from tidemark.functions.calendar import (  # noqa: F401
    as_date, iso_week, iso_year, last_saturday_on_or_before, week_ending_saturday,
)
from tidemark.functions.scalar import (  # noqa: F401
    cap, clean_name, nan_to_null, pct_chg, round_ratio_half_even, ratio,
    slug, to_double, to_int_trunc,
)
