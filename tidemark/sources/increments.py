"""Aggregates of a growing table, kept per input file, so that a run reads new files only.

A fact table that grows by files is aggregated once per file: to (file, keys) with sums,
minima and maxima, which merge. A run lists the files (names, lengths and
modification times; a Spark job that reads no content), aggregates those it has not seen
in this state, and merges the partial rows of the files that are there now:

* an appended file is read, the others are not;
* a file that was written anew has a new state: its old partial rows no longer take part and
  it is read again, so late corrections restate the days they touch;
* a file that is gone takes its rows with it.

Partial rows go to ``<store>/partials/run_id=<run>``; then the run's files are noted in
``<store>/files``, which commits them. A run that dies before leaves rows nobody reads. A file counts
with the run that noted it last, so two runs at a time repeat work but no row.

Partial rows are as many as files x keys that occur in a file: few where files are laid down by
date. They are written for all columns that any consumer asks of the store, so different
consumers of one table should share a store.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.listing import exists, file_listing

STATE = ("file_path", "file_size", "file_modification_time")
MERGES = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass
class Refresh:
    """The merged aggregate and what a run read for it."""

    table: DataFrame
    new_files: int
    rows_read: int


@dataclass
class IncrementalAggregate:
    """``keys``: name -> Column over the table; ``measures``: name -> (sum, min or max; Column).

    A count is the sum of ``lit(1)``. Sums over groups without a value are NULL, as in Spark.
    """

    spark: SparkSession
    source: str                 # folder (or file) of the Parquet table
    store: str
    keys: Mapping[str, Column]
    measures: Mapping[str, tuple[str, Column]]
    _columns: list[str] = field(init=False)

    def __post_init__(self):
        clash = (set(self.keys) | set(self.measures)) & {*STATE, "run_id"}
        if clash or set(self.keys) & set(self.measures):
            raise ValueError(f"column names used twice or taken by the store: {sorted(clash or set(self.keys) & set(self.measures))}")
        self._columns = [*self.keys, *self.measures]

    @property
    def _partials(self) -> str:
        return os.path.join(self.store, "partials")

    @property
    def _noted(self) -> str:
        return os.path.join(self.store, "files")

    def files(self) -> DataFrame | None:
        """The noted files with the run whose partial rows count; None before the first run."""
        if not exists(self.spark, self._noted):
            return None
        last = Window.partitionBy(*STATE).orderBy(F.col("noted_at").desc(), F.col("run_id").desc())
        return (self.spark.read.parquet(self._noted).withColumn("_n", F.row_number().over(last))
                .where("_n = 1").select(*STATE, "run_id"))

    def refresh(self) -> Refresh:
        """Aggregate the files that are new or changed and merge all that are there."""
        now = file_listing(self.spark, self.source).select(*STATE, "path")
        noted = self.files()
        fresh = now if noted is None else now.join(noted, list(STATE), "left_anti")
        # driver memory: one path for each new file, as Spark's own file index holds them
        paths = [r["path"] for r in fresh.select("path").collect()]
        rows = self._aggregate(paths) if paths else 0
        noted = self.files()
        if noted is None:       # an empty folder
            raise FileNotFoundError(f"no file in {self.source}")
        valid = now.select(*STATE).join(noted, list(STATE))
        partial = self.spark.read.parquet(self._partials).join(valid, [*STATE, "run_id"], "left_semi")
        merged = partial.groupBy(*self.keys).agg(*[MERGES[how](name).alias(name) for name, (how, _) in self.measures.items()])
        return Refresh(merged, len(paths), rows)

    def _aggregate(self, paths: list[str]) -> int:
        """Write and note the partial rows of the named files; the number of rows read."""
        run_id = uuid.uuid4().hex
        seen = Observation()
        facts = self.spark.read.parquet(*paths)
        state = [F.col(f"_metadata.{c}").alias(c) for c in STATE]
        rows = facts.select(*state, *[c.alias(k) for k, c in self.keys.items()], *[c.alias(m) for m, (_, c) in self.measures.items()])
        rows = rows.observe(seen, F.count(F.lit(1)).alias("n"))
        partial = rows.groupBy(*STATE, *self.keys).agg(*[MERGES[how](name).alias(name) for name, (how, _) in self.measures.items()])
        (partial.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(self._partials))
        # noted as they were when read: a file without rows has no state there and is noted as listed
        read = self.spark.read.parquet(os.path.join(self._partials, f"run_id={run_id}")).select(*STATE).distinct()
        listed = file_listing(self.spark, *paths).select(*STATE).join(read, "file_path", "left_anti")
        (read.unionByName(listed).withColumn("run_id", F.lit(run_id)).withColumn("noted_at", F.current_timestamp())
         .coalesce(1).write.mode("append").parquet(self._noted))
        return seen.get["n"]
