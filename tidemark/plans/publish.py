"""Publish every output of one weekly run, all or nothing.

1. The analysis week follows the last committed one (S7): ``next_week`` reads the
   manifest and adds seven days; the first run takes the newest week of the data.
   ``publish_due`` repeats until the newest week is out, so a missed week is caught up.
2. Every table is computed and written under
   ``<out>/<table>/run_id=<run_id>/analysis_week=<week>/`` (the dated sink). The tables
   that are a history (``HISTORIES``) keep what the last committed run published and
   add only newer dates up to the analysis week, so a late correction of the feeds never
   rewrites a published week; reports and deep dives use the current feeds.
3. The readiness gate (D11) must pass: every feed has the analysis week and
   the week before. Otherwise the run raises and nothing becomes visible.
4. Commit: a numbered entry of the manifest (``plans.manifest``), made exactly once. Readers
   only see runs listed there (``read_published``), so a run that died half-way - including a
   lost executor mid-write - is never read; re-running writes a fresh run folder and
   ``manifest.sweep`` removes the dead one. Of two runs at a time one commits; the other
   starts again from the new state, or gives up if its week is out.
5. Tables may gain columns (a new category): earlier weeks have NULL there.

Deep dives are published by the same commit (the reference wrote them before
its gate, deviation V6). The run owns its staged tables and deletes them at the end.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.composite import append_newer
from tidemark.plans import feeds as fd
from tidemark.plans import manifest as mf
from tidemark.sources.tables import BASE_YEAR, SINCE, Tables

# Tables whose published dates are kept, and their date column.
HISTORIES = {"overview": "date", "rentals": "week_end", "hospital": "d", "restaurants": "d"}


def _tables():
    from tidemark.operators import composite as cp
    from tidemark.plans import q_composite as qc
    from tidemark.plans import q_series as qs
    return {
        # main tables
        "restaurants": fd.restaurants, "subway": fd.subway, "claims": fd.claims,
        "hospital": fd.hospital, "home_sales": fd.home_sales, "rentals": fd.rentals,
        "wow_changes": qc.wow_report,
        "overview": lambda t: cp.scores(fd.six_way_join(t), fd.MEASURES).where(F.col("date") <= fd.asof_value(t)),
        # deep dives
        "series_compare": qs.series_compare, "feed_rollmean": qs.across_rollmean,
        "monthly_share": qs.share_wide, "monthly_share_status": qs.share_wide_status,
        "weekly_share": qs.share_weekly, "region_rollup": qs.facility_rollup,
        "area_changes": qs.horizon_change, "rental_changes": qs.rental_change,
        "area_indexes": qs.wide_area_index,
    }


class NotReady(RuntimeError):
    """A feed lacks the analysis week or the week before; nothing published."""


def last_week(spark: SparkSession, out_dir: str) -> dt.date | None:
    """The newest committed analysis week, None before the first run."""
    return max((r["analysis_week"] for r in mf.committed(spark, out_dir)), default=None)


def next_week(spark: SparkSession, sf_dir: str, out_dir: str, **options) -> dt.date:
    """The week after the last committed one; the newest week of the data before the first run."""
    last = last_week(spark, out_dir)
    return last + dt.timedelta(days=7) if last else newest_week(spark, sf_dir, **options)


def newest_week(spark: SparkSession, sf_dir: str, **options) -> dt.date:
    return fd.asof(Tables(spark, sf_dir, **options)).first()["asof"]


def publish(spark: SparkSession, sf_dir: str, out_dir: str, run_id: str | None = None,
            catalog_db: str | None = None, week: dt.date | None = None,
            base_year: int = BASE_YEAR, since: dt.date = SINCE, increments: str | None = None, attempts: int = 3) -> str:
    """One weekly run for ``week`` (default: ``next_week``); ``catalog_db`` reads the
    bucketed layout where present, ``increments`` keeps day aggregates per input file."""
    run_id = run_id or uuid.uuid4().hex
    for left in range(attempts - 1, -1, -1):
        runs = mf.committed(spark, out_dir)
        due = week or next_week(spark, sf_dir, out_dir, catalog_db=catalog_db)
        t = Tables(spark, sf_dir, catalog_db=catalog_db, base_year=base_year, since=since, week=due, own_stages=True,
                   increments=increments)
        try:
            schemas = _write(spark, t, out_dir, due, run_id, runs)
            mf.commit(spark, out_dir, due, run_id, schemas, runs[-1]["version"] + 1 if runs else 1)
            return run_id
        except mf.Conflict:     # the histories go on from a state that is not the last any more
            for name in _tables():
                mf.delete(spark, os.path.join(out_dir, name, f"run_id={run_id}"))
            others = [r["run_id"] for r in mf.committed(spark, out_dir)[len(runs):] if r["analysis_week"] == due]
            if others or not left:
                raise
        finally:
            t.release()
    raise AssertionError("not reached")


def _write(spark: SparkSession, t: Tables, out_dir: str, week: dt.date, run_id: str, runs: list) -> dict:
    """Check the feeds, then write every table of the run; their schemas."""
    from tidemark.plans.q_composite import feed_status
    before = max((r["analysis_week"] for r in runs), default=None)
    if not feed_status(t).where(~F.col("present")).isEmpty():
        raise NotReady(f"feeds missing {week} or the week before")
    tables = {}
    for name, build in _tables().items():
        tables[name] = build(t)
        if name in HISTORIES and before is not None:
            kept = read_published(spark, out_dir, name).where(F.col("analysis_week") == F.lit(before)).drop("analysis_week")
            tables[name] = append_newer(kept, tables[name], HISTORIES[name], F.lit(week))
    return mf.write_run(out_dir, week, run_id, tables, runs)


def publish_due(spark: SparkSession, sf_dir: str, out_dir: str, **options) -> list[str]:
    """Publish every week that is due, oldest first; none if the newest is out."""
    newest = newest_week(spark, sf_dir, catalog_db=options.get("catalog_db"))
    runs = []
    while (week := next_week(spark, sf_dir, out_dir, catalog_db=options.get("catalog_db"))) <= newest:
        runs.append(publish(spark, sf_dir, out_dir, week=week, **options))
    return runs


def read_published(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The latest committed run of each analysis week, for one table, with the columns of all its runs."""
    return mf.read_table(spark, out_dir, table)


def main(argv=None) -> None:
    """``python -m tidemark.plans.publish <tables dir> <output dir> [catalog db] [base year] [first date] [increments dir]``:
    every weekly run that is due, on the cluster that spark-submit names."""
    import sys
    from tidemark.session import SCALE_CONF
    args = list(sys.argv[1:] if argv is None else argv)
    if not 2 <= len(args) <= 6:
        raise SystemExit("usage: python -m tidemark.plans.publish <tables dir> <output dir> [catalog db] [base year] [first date] [increments dir]")
    spark = SparkSession.getActiveSession()
    if spark is None:  # the master and all sizes are those of the submission
        builder = SparkSession.builder.appName("tidemark-publish")
        for k, v in SCALE_CONF.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    options = {"catalog_db": args[2] or None} if len(args) > 2 else {}
    if len(args) > 3:
        options["base_year"] = int(args[3])
    if len(args) > 4:
        options["since"] = dt.date.fromisoformat(args[4])
    if len(args) > 5:
        options["increments"] = args[5]
    print("\n".join(publish_due(spark, args[0], args[1], **options)))


def export_csv(spark: SparkSession, out_dir: str, table: str, dest: str) -> None:
    """Write the latest committed run of a published table as CSV (header,
    ``NA`` for NULL, ISO dates), one folder per analysis week
    (``dest/analysis_week=YYYY-MM-DD/``) - the dated files a chart tool reads."""
    from tidemark.sources.csv_io import write_csv
    write_csv(read_published(spark, out_dir, table), dest, partition_by=["analysis_week"])


if __name__ == "__main__":
    main()
