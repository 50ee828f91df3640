"""The publish job (D10) and the streaming history append."""

import os
import tempfile

from pyspark.sql import functions as F

from paths import SF01

import __spark_entry__ as E


def _fresh():
    return tempfile.mkdtemp(prefix="tidemark-test-")


def test_publish_commits_all_tables(spark):
    from tidemark.plans.publish import publish, read_published, _tables
    out = _fresh()
    run = publish(spark, SF01, out)
    assert os.path.isdir(os.path.join(out, "overview", f"run_id={run}"))
    ov = read_published(spark, out, "overview")
    assert ov.count() == E.queries()["overview"](spark, SF01).count()
    assert ov.select("analysis_week").distinct().count() == 1
    # a second run of the same week supersedes the first for readers
    week = ov.first()["analysis_week"]
    publish(spark, SF01, out, week=week)
    assert read_published(spark, out, "wow_changes").count() == 7
    assert len(_tables()) == 17
    # CSV export of the latest committed run, read back typed
    from tidemark.plans.publish import export_csv
    from tidemark.sources.csv_io import read_typed_csv
    dest = os.path.join(_fresh(), "wow_csv")
    export_csv(spark, out, "wow_changes", dest)
    back = read_typed_csv(spark, dest, "measure STRING, change DOUBLE, analysis_week DATE")
    assert back.count() == 7 and back.select("analysis_week").distinct().count() == 1


def test_stream_appends_only_new_weeks_and_is_idempotent(spark):
    from tidemark.streaming.history_append import start_history_append
    scores = E.queries()["overview"](spark, SF01)
    schema = scores.schema
    landing, history, ckpt = _fresh(), os.path.join(_fresh(), "h"), os.path.join(_fresh(), "c")
    cut = "2001-01-01"
    scores.where(F.col("date") < cut).write.mode("append").parquet(landing)
    q = start_history_append(spark, landing, history, schema, checkpoint=ckpt)
    q.awaitTermination()
    first = spark.read.parquet(history).count()
    assert first == scores.where(F.col("date") < cut).count()
    # next week's run lands the full table again (old weeks included)
    scores.write.mode("append").parquet(landing)
    start_history_append(spark, landing, history, schema, checkpoint=ckpt).awaitTermination()
    h = spark.read.parquet(history)
    assert h.count() == scores.count() and h.select("date").distinct().count() == scores.count()
    # replay from a fresh checkpoint: nothing is appended twice
    start_history_append(spark, landing, history, schema, checkpoint=ckpt + "2").awaitTermination()
    assert spark.read.parquet(history).count() == scores.count()


def test_publish_refuses_when_a_feed_is_missing(spark, monkeypatch):
    import pytest
    from tidemark.plans import publish as pub
    from tidemark.plans import q_composite

    original = q_composite.feed_status

    def not_ready(t):
        return original(t).withColumn("present", F.col("feed") != F.lit("claims"))

    monkeypatch.setattr(q_composite, "feed_status", not_ready)
    out = _fresh()
    with pytest.raises(pub.NotReady):
        pub.publish(spark, SF01, out)
    assert not os.path.exists(os.path.join(out, "_published"))
    assert not os.path.exists(os.path.join(out, "overview"))


def _changed_copy(spark, drop_after=None, shift_before=None):
    """sf0.01 with ``orders`` cut at a date, or with its old rows doubled."""
    import datetime as dt
    import shutil
    d = _fresh()
    for name in ("customer", "lineitem", "nation", "region", "supplier", "pages", "events"):
        os.symlink(os.path.join(SF01, f"{name}.parquet"), os.path.join(d, f"{name}.parquet"))
    o = spark.read.parquet(os.path.join(SF01, "orders.parquet"))
    if drop_after:
        o = o.where(F.col("o_orderdate") < F.lit(dt.datetime.fromisoformat(drop_after)))
    if shift_before:
        old = F.col("o_orderdate") < F.lit(dt.datetime.fromisoformat(shift_before))
        o = o.unionByName(o.where(old & (F.col("o_orderpriority") == "1-URGENT")))
    o.write.parquet(os.path.join(d, "orders.parquet"))
    del shutil
    return d


def test_published_weeks_stay_and_missed_weeks_are_caught_up(spark):
    from tidemark.plans.publish import last_week, publish_due, read_published
    out = _fresh()
    publish_due(spark, _changed_copy(spark, drop_after="2001-07-08"), out)
    first = last_week(spark, out)
    assert first.isoformat() == "2001-07-07"
    kept = {tuple(r) for r in read_published(spark, out, "overview").drop("analysis_week").collect()}
    # two weeks later, with old orders corrected: both weeks come out, the old rows stay
    later = _changed_copy(spark, drop_after="2001-07-22", shift_before="2001-06-01")
    assert len(publish_due(spark, later, out)) == 2
    assert last_week(spark, out).isoformat() == "2001-07-21"
    assert publish_due(spark, later, out) == []
    now = read_published(spark, out, "overview").where("analysis_week = DATE '2001-07-21'").drop("analysis_week")
    rows = {tuple(r) for r in now.collect()}
    assert kept < rows and len(rows) == len(kept) + 2
    current = {tuple(r) for r in E.queries()["composite_total"](spark, later).drop("composite_index").collect()}
    assert not kept <= current      # the recomputed history would differ


def test_a_run_sees_appended_rows(spark):
    from tidemark.plans import feeds as fd
    from tidemark.sources.tables import Tables
    d = _changed_copy(spark, drop_after="2001-01-01")
    total = lambda: fd.orders_daily(Tables(spark, d)).agg(F.sum("n")).first()[0]
    before = total()
    spark.read.parquet(os.path.join(SF01, "orders.parquet")).limit(500).write.mode("append").parquet(os.path.join(d, "orders.parquet"))
    assert total() == before + 500


def test_unseen_category_gets_its_column(spark):
    from tidemark.plans import q_series as qs
    from tidemark.sources.tables import Tables
    d = _fresh()
    o = spark.read.parquet(os.path.join(SF01, "orders.parquet"))
    half = F.when(F.col("o_orderkey") % 2 == 0, "9-NEW").otherwise(F.col("o_orderpriority"))
    o.withColumn("o_orderpriority", half).write.parquet(os.path.join(d, "orders.parquet"))
    wide = qs.share_wide(Tables(spark, d))
    assert "x9_new" in wide.columns
    shares = [c for c in wide.columns if c != "month"]
    for r in wide.collect():
        assert abs(sum(r[c] or 0 for c in shares) - 100) < 0.05


def test_publish_entry_keeps_the_sessions_master(spark):
    from tidemark.plans import publish as pub
    import inspect
    assert "build_session" not in inspect.getsource(pub.main)


def test_stream_rule_is_the_batch_rule(spark):
    import datetime as dt
    from tidemark.streaming.history_append import start_history_append
    day = lambda s: dt.date.fromisoformat(s)
    frame = lambda *rows: spark.createDataFrame([(day(d), v) for d, v in rows], "date date, v double")
    for _ in range(2):          # two landing/history pairs, both with the default checkpoint
        landing, history = _fresh(), os.path.join(_fresh(), "h")
        schema = frame(("2022-01-08", 1.0)).schema
        frame(("2022-01-08", 1.0), ("2022-01-22", 2.0)).write.mode("append").parquet(landing)
        start_history_append(spark, landing, history, schema).awaitTermination()
        # a back-dated week and one after the cutoff stay out
        frame(("2022-01-15", 9.0), ("2022-01-29", 3.0), ("2022-02-05", 4.0)).write.mode("append").parquet(landing)
        start_history_append(spark, landing, history, schema, upto=day("2022-01-29")).awaitTermination()
        got = sorted((r.date.isoformat(), r.v) for r in spark.read.parquet(history).collect())
        assert got == [("2022-01-08", 1.0), ("2022-01-22", 2.0), ("2022-01-29", 3.0)]


def test_readiness_is_measured_by_the_writes(spark):
    from tidemark.plans import feeds as fd
    from tidemark.plans import q_composite as qc
    from tidemark.sources.tables import Tables
    t = Tables(spark, SF01, own_stages=True)
    try:
        got = qc.feed_status(t)
        scans = got._jdf.queryExecution().optimizedPlan().toString()
        assert "index#" not in scans and all(t.dates_written(f"feed_{n}") for n in qc._FEEDS)
        for name, (_, date) in qc._FEEDS.items():  # as a scan of the feed would have it
            rows = getattr(fd, name)(t).where(F.col("index").isNotNull()).select(date).distinct().collect()
            assert sorted(r[0] for r in rows) == t.dates_written(f"feed_{name}")
        # a table without rows has no dates
        assert t.stage("none", lambda: t.orders.limit(0), ["orders"], watch=("o_orderdate", "o_orderkey")).count() == 0
        assert t.dates_written("none") == [] and t.dates_written("other") is None
    finally:
        t.release()
