"""Committed runs: columns that grow, exactly one commit, dead runs."""

import datetime as dt
import os
import tempfile
import threading

import pytest

from paths import SF01
from tidemark.plans import manifest as mf

WEEK1, WEEK2 = dt.date(2022, 1, 8), dt.date(2022, 1, 15)


def _run(spark, out, week, run_id, tables):
    runs = mf.committed(spark, out)
    schemas = mf.write_run(out, week, run_id, tables, runs)
    mf.commit(spark, out, week, run_id, schemas, runs[-1]["version"] + 1 if runs else 1)


def _fresh():
    return os.path.join(tempfile.mkdtemp(prefix="tidemark-test-"), "out")


def test_a_column_that_appears_in_week_two_is_null_in_week_one(spark):
    out = _fresh()
    _run(spark, out, WEEK1, "r1", {"t": spark.createDataFrame([("a", 1, 2)], "id string, x int, gone int")})
    _run(spark, out, WEEK2, "r2", {"t": spark.createDataFrame([("a", 5, 7.5)], "id string, x bigint, y double"),
                                   "late": spark.createDataFrame([(1,)], "z int")})
    got = mf.read_table(spark, out, "t")
    assert got.columns == ["id", "x", "gone", "y", "analysis_week"] and got.schema["x"].dataType.simpleString() == "bigint"
    rows = {r.analysis_week: r.asDict() for r in got.collect()}
    assert rows[WEEK1] == {"id": "a", "x": 1, "gone": 2, "y": None, "analysis_week": WEEK1}
    assert rows[WEEK2] == {"id": "a", "x": 5, "gone": None, "y": 7.5, "analysis_week": WEEK2}
    assert mf.read_table(spark, out, "late").count() == 1
    # a second run of week one supersedes the first
    _run(spark, out, WEEK1, "r3", {"t": spark.createDataFrame([("b", 9)], "id string, x int")})
    assert {r.id for r in mf.read_table(spark, out, "t").where(f"analysis_week = DATE'{WEEK1}'").collect()} == {"b"}
    assert "run_id" in mf.read_table(spark, out, "t")._jdf.queryExecution().executedPlan().toString()


def test_a_changed_type_is_refused_before_anything_is_written(spark):
    out = _fresh()
    _run(spark, out, WEEK1, "r1", {"t": spark.createDataFrame([(1,)], "x int")})
    with pytest.raises(mf.SchemaChanged, match="t.x is string"):
        _run(spark, out, WEEK2, "r2", {"t": spark.createDataFrame([("1",)], "x string")})
    assert not os.path.exists(os.path.join(out, "t", "run_id=r2")) and len(mf.committed(spark, out)) == 1


def test_one_of_many_commits_of_a_version(spark):
    out, done, lost = _fresh(), [], []
    def one(i):
        try:
            mf.commit(spark, out, WEEK1, f"r{i}", {}, 1)
            done.append(i)
        except mf.Conflict:
            lost.append(i)
    mf.commit(spark, out, WEEK1, "first", {}, 1)
    threads = [threading.Thread(target=one, args=(i,)) for i in range(6)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert not done and len(lost) == 6 and [r["run_id"] for r in mf.committed(spark, out)] == ["first"]
    assert not [f for f in os.listdir(os.path.join(out, mf.FOLDER)) if not f.endswith((".json", ".json.crc"))]


def test_the_later_of_two_publishers_of_a_week_leaves_nothing(spark, monkeypatch):
    from tidemark.plans import publish as pub
    out = _fresh()
    few = {"overview": pub._tables()["overview"]}
    monkeypatch.setattr(pub, "_tables", lambda: few)
    real = pub._write

    def overtaken(spark, t, out_dir, week, run_id, runs):
        schemas = real(spark, t, out_dir, week, run_id, runs)
        monkeypatch.setattr(pub, "_write", real)
        pub.publish(spark, SF01, out_dir, run_id="winner", week=week)      # commits while we are still writing
        return schemas

    monkeypatch.setattr(pub, "_write", overtaken)
    with pytest.raises(mf.Conflict):
        pub.publish(spark, SF01, out, run_id="loser", increments=os.path.join(out, "..", "increments"))
    assert [r["run_id"] for r in mf.committed(spark, out)] == ["winner"]
    assert os.listdir(os.path.join(out, "overview")) == ["run_id=winner"]
    assert pub.read_published(spark, out, "overview").count() > 0
    assert os.path.isdir(os.path.join(out, "..", "increments"))


def test_sweep_removes_dead_runs_only(spark):
    out = _fresh()
    _run(spark, out, WEEK1, "r1", {"t": spark.range(2)})
    mf.write_run(out, WEEK2, "dead", {"t": spark.range(3)}, mf.committed(spark, out))
    assert mf.sweep(spark, out, hours=1) == [] and mf.sweep(spark, out, hours=-1) == ["dead"]
    assert os.listdir(os.path.join(out, "t")) == ["run_id=r1"] and mf.read_table(spark, out, "t").count() == 2
