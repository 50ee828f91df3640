"""tidemark: baseline-relative indicators on Spark.

Daily and weekly series from fact tables, trailing row windows, seasonal
baselines keyed by ISO week, capped 0-100 indices, a six-measure composite,
week-over-week reports and an append-only history - all as DataFrame and
Column operators that Catalyst plans.

Packages: ``functions`` (Column helpers), ``operators`` (DataFrame
operators), ``sources`` (tables, CSV, embedded payloads), ``plans`` (feeds,
registered queries, oracle SQL, publish job), ``streaming`` (history append).
"""

__version__ = "0.1.0"
