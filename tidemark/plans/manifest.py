"""The manifest of published runs: numbered entries, each made exactly once.

``<out>/_published/<version>.json`` names a committed run: its analysis week, run folder and
the schema of every table it wrote. An entry is written aside and renamed to its number, which
fails where the number is taken; so of two runs that started from one state one commits,
and the other learns of it. Readers take the newest entry of each week.

Columns may come and go between runs. A table is read with the columns of all its
committed runs, in the order in which they first appeared; a run without a column has NULL there.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.listing import exists, file_listing

FOLDER = "_published"
ENTRY = "version BIGINT, analysis_week DATE, run_id STRING, committed_at STRING, schemas MAP<STRING, STRING>"
# Types that a column may change to from run to run: Parquet is read as the wider one.
WIDER = [("int", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("float", "double"), ("int", "double"), ("date", "timestamp_ntz")]


class Conflict(RuntimeError):
    """Another run committed first."""


class SchemaChanged(ValueError):
    """A column has a type that does not go together with its type in earlier runs."""


def entries(spark: SparkSession, out_dir: str) -> DataFrame | None:
    """The committed runs, None before the first."""
    folder = os.path.join(out_dir, FOLDER)
    return spark.read.schema(ENTRY).json(folder, multiLine=True) if exists(spark, folder) else None


def committed(spark: SparkSession, out_dir: str) -> list[T.Row]:
    """The committed runs in order: one short row a run, so they fit the driver."""
    found = entries(spark, out_dir)
    return [] if found is None else sorted(found.collect(), key=lambda r: r["version"])


def merged_schema(table: str, schemas: Iterable[T.StructType]) -> T.StructType:
    """All columns in order of first appearance (names as Spark compares them), widened where needed."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            old = fields.get(f.name.lower())
            if old is None or (old.dataType.simpleString(), f.dataType.simpleString()) in WIDER:
                fields[f.name.lower()] = T.StructField(f.name if old is None else old.name, f.dataType, True)
            elif old.dataType.simpleString() != f.dataType.simpleString() and \
                    (f.dataType.simpleString(), old.dataType.simpleString()) not in WIDER:
                raise SchemaChanged(f"{table}.{f.name} is {f.dataType.simpleString()}, in earlier runs {old.dataType.simpleString()}")
    return T.StructType(list(fields.values()))


def schemas_of(table: str, runs: Iterable[T.Row]) -> list[T.StructType]:
    return [T.StructType.fromJson(json.loads(r["schemas"][table])) for r in runs if table in (r["schemas"] or {})]


def commit(spark: SparkSession, out_dir: str, week: dt.date, run_id: str, schemas: Mapping[str, T.StructType], version: int) -> None:
    """Make entry number ``version``; raises ``Conflict`` where another run has made it."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda name: jvm.org.apache.hadoop.fs.Path(os.path.join(out_dir, FOLDER, name))
    entry = {"version": version, "analysis_week": week.isoformat(), "run_id": run_id,
             "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(), "schemas": {t: s.json() for t, s in schemas.items()}}
    aside, final = path(f".{uuid.uuid4().hex}"), path(f"{version:08d}.json")
    fs = final.getFileSystem(conf)
    out = fs.create(aside, False)
    out.write(bytearray(json.dumps(entry).encode()))
    out.close()
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), conf)
        context.rename(aside, final, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        fs.delete(aside, False)
        if fs.exists(final):
            raise Conflict(f"version {version} of {out_dir} is committed already") from e
        raise


def write_run(out_dir: str, week: dt.date, run_id: str, tables: Mapping[str, DataFrame], runs: list[T.Row]) -> dict[str, T.StructType]:
    """Write the tables of a run to folders of its own; nothing is visible before ``commit``.

    Schemas that do not go together with those of ``runs`` are refused before anything is written."""
    schemas = {name: df.schema for name, df in tables.items()}
    for name, schema in schemas.items():
        merged_schema(name, [*schemas_of(name, runs), schema])
    for name, df in tables.items():
        (df.withColumn("analysis_week", F.lit(week)).write.mode("overwrite").partitionBy("analysis_week")
         .parquet(os.path.join(out_dir, name, f"run_id={run_id}")))
    return schemas


def read_table(spark: SparkSession, out_dir: str, table: str) -> DataFrame:
    """The latest committed run of each analysis week, with the columns of all committed runs."""
    runs = committed(spark, out_dir)
    latest = {r["analysis_week"]: r["run_id"] for r in runs if table in (r["schemas"] or {})}
    schema = merged_schema(table, schemas_of(table, runs))
    schema = T.StructType([*schema.fields, T.StructField("run_id", T.StringType()), T.StructField("analysis_week", T.DateType())])
    data = spark.read.schema(schema).parquet(os.path.join(out_dir, table))
    # literals on the partition columns prune the folders of all other runs
    return data.where(F.col("run_id").isin(sorted(latest.values()))).drop("run_id")


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def sweep(spark: SparkSession, out_dir: str, hours: float = 24.0) -> list[str]:
    """Delete the folders of runs that never committed and wrote nothing for ``hours``; the run ids."""
    known = [r["run_id"] for r in committed(spark, out_dir)]
    runs = file_listing(spark, out_dir).select(F.regexp_extract("path", r"/([^/]+)/run_id=([^/]+)/", 1).alias("table"),
                                               F.regexp_extract("path", r"/run_id=([^/]+)/", 1).alias("run_id"), "modified")
    old = (runs.where((F.col("run_id") != "") & ~F.col("run_id").isin(known)).groupBy("table", "run_id").agg(F.max("modified").alias("last"))
           .where(F.col("last") < F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600.0).cast("decimal(18,6)"))))
    found = old.select("table", "run_id").collect()
    for r in found:
        delete(spark, os.path.join(out_dir, r["table"], f"run_id={r['run_id']}"))
    return sorted({r["run_id"] for r in found})
