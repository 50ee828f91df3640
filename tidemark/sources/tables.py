"""Table access by name over a folder of parquet files.

Reads are lazy: a query that uses two columns of ``lineitem`` reads two
columns (Catalyst prunes the scan), and filters on raw columns reach the
parquet reader as pushed filters.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Staged tables of this driver process: (app id, session, folder, stage name,
# input fingerprint) -> (path, relation, dates where watched). A weekly run that publishes many outputs scans each
# fact table once; a changed input gives a new fingerprint and a new stage.
_STAGED: dict[tuple, tuple[str, DataFrame, list | None]] = {}
# Parquet relations of this driver process, by (app id, session, path, fingerprint):
# resolving a relation lists files and reads footers (~80 ms per table), so
# queries of one run share it; changed files give a new fingerprint.
_READS: dict[tuple, DataFrame] = {}
# Default parameters of a run: the year that plays the pre-period and the first
# date that is analysed (the test tables span 1995-2001).
BASE_YEAR = 1997
SINCE = dt.date(1998, 1, 1)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


class Tables:
    """``Tables(spark, dir).orders`` -> DataFrame of ``dir/orders.parquet``.

    One instance is one run: it lists its input files once, at first use, and every
    query of the run sees that state; a new run lists them again. ``base_year``,
    ``since`` and ``week`` are the run's parameters. With ``own_stages`` the staged
    tables belong to this run alone and ``release`` deletes them; otherwise runs of
    one application share a stage while its input files are the same.

    With ``increments``, a folder that outlives the run, the day aggregates of the fact tables
    are kept there per input file, and a run reads the files that are new or changed.

    With ``catalog_db``, tables present in that catalog database (the bucketed
    layout of ``sources.layout``) are read from the catalog so Spark knows
    their bucketing; the others are read by path from ``dir``."""

    def __init__(self, spark: SparkSession, sf_dir: str, catalog_db: str | None = None,
                 base_year: int = BASE_YEAR, since: dt.date = SINCE, week: dt.date | None = None,
                 own_stages: bool = False, increments: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.catalog_db = catalog_db
        self.base_year = base_year
        self.since = since
        self.week = week            # analysis week; None: taken from the data
        self.increments = increments
        self._registry = {} if own_stages else _STAGED
        self._own = own_stages
        self._cache: dict[str, DataFrame] = {}
        self._stages: dict[str, DataFrame] = {}
        self._dates: dict[str, list[dt.date] | None] = {}
        self._memo: dict[str, DataFrame] = {}
        self._prints: dict[str, tuple] = {}
        self._locations: dict[str, str] = {}

    def table(self, name: str) -> DataFrame:
        """The named table: catalog table, or a parquet relation shared by the run."""
        if name not in self._cache:
            from tidemark.session import is_classic
            if self._in_catalog(name):
                self._cache[name] = self.spark.table(f"{self.catalog_db}.{name}")
            elif not is_classic(self.spark):
                self._cache[name] = self.spark.read.parquet(self.path(name))
            else:
                key = (self.spark.sparkContext.applicationId, id(self.spark), self.path(name),
                       self.fingerprint([name]))
                if key not in _READS:
                    _READS[key] = self.spark.read.parquet(self.path(name))
                self._cache[name] = _READS[key]
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)

    def _in_catalog(self, name: str) -> bool:
        return bool(self.catalog_db) and self.spark.catalog.tableExists(f"{self.catalog_db}.{name}")

    def path(self, name: str) -> str:
        """Storage location of the named table."""
        if self._in_catalog(name):
            if name not in self._locations:   # catalog metadata, not data
                rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.catalog_db}.{name}").collect()
                self._locations[name] = next(r.data_type for r in rows if r.col_name == "Location")
            return self._locations[name]
        return os.path.join(self.sf_dir, f"{name}.parquet")

    def _listing(self, path: str) -> tuple[int, str]:
        """Bytes below ``path`` and a digest of path, length and modification time of every
        file: sums over a listing that Spark makes and adds up (no data read)."""
        from tidemark.sources.listing import file_listing
        file = F.struct("file_path", "file_size", "file_modification_time")
        found = file_listing(self.spark, path).agg(
            F.coalesce(F.sum("length"), F.lit(0)).alias("size"), F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64(file).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("a"),
            F.coalesce(F.sum(F.xxhash64(F.lit(1), file).cast("decimal(38,0)")), F.lit(0)).cast("string").alias("b")).first()
        return found["size"], f"{found['n']}:{found['a']}:{found['b']}"

    def fingerprint(self, names) -> tuple:
        """(table, bytes, digest of its file listing) per input, fixed for this run."""
        for n in names:
            if n not in self._prints:
                self._prints[n] = (n, *self._listing(self.path(n)))
        return tuple(self._prints[n] for n in names)

    def size_bytes(self, *names: str) -> int:
        """Bytes on disk of the named tables (metadata only)."""
        return sum(size for _, size, _ in self.fingerprint(names))

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def stage(self, name: str, build, inputs, watch: tuple[str, str] | None = None) -> DataFrame:
        """Materialise ``build()`` as parquet in the shared checkpoint folder
        and read it back; reuse it while the inputs are unchanged. ``watch`` names a date and
        a value column of a table by days or weeks: ``dates_written`` then tells the dates with a value,
        noted by the write itself (bounded by the calendar).

        Used for the day-grain aggregates that many feeds share: each fact
        table is scanned once (Catalyst prunes a different column set per
        consumer, which would defeat exchange reuse), the lineage is cut (a
        lost executor re-reads a small durable file rather than rescanning
        the facts), and later reads carry real size statistics for AQE.
        """
        from tidemark.session import is_classic
        if not is_classic(self.spark):
            return build()   # Spark Connect: no file-system access here; plan stays lazy
        if name not in self._stages:
            from tidemark.session import scratch_path
            key = (self.spark.sparkContext.applicationId, id(self.spark), self.sf_dir, name,
                   self.base_year, self.since, self.week, self.fingerprint(inputs))
            hit = self._registry.get(key)
            if hit is None or not self._exists(hit[0]):
                path = scratch_path(self.spark, name)
                rows, dates = build(), None
                if watch:
                    seen, (date, value) = Observation(), watch
                    rows = rows.observe(seen, F.collect_set(F.when(F.col(value).isNotNull(), F.col(date))).alias("dates"))
                rows.write.mode("overwrite").parquet(path)
                if watch:
                    dates = sorted(seen.get["dates"])
                hit = self._registry[key] = (path, self.spark.read.parquet(path), dates)
            self._stages[name], self._dates[name] = hit[1:]
        return self._stages[name]

    def dates_written(self, name: str) -> list[dt.date] | None:
        """The dates with a value of a watched stage; None where nothing was noted."""
        return self._dates.get(name)

    def aggregate(self, name: str, keys: dict[str, Column], measures: dict[str, tuple[str, Column]]) -> DataFrame:
        """Aggregate of the named table by ``keys``; ``measures``: name -> (sum, min or max; Column).

        Every row is read, unless the run keeps increments: then only those of new or changed files.
        A table that is read from a catalog is not kept by file."""
        from tidemark.sources.increments import MERGES, IncrementalAggregate
        if self.increments and not self._in_catalog(name):
            store = os.path.join(self.increments, f"{name}-{'-'.join(keys)}")
            return IncrementalAggregate(self.spark, self.path(name), store, keys, measures).refresh().table
        rows = self.table(name).select(*[c.alias(k) for k, c in keys.items()], *[c.alias(m) for m, (_, c) in measures.items()])
        return rows.groupBy(*keys).agg(*[MERGES[how](m).alias(m) for m, (how, _) in measures.items()])

    def release(self) -> None:
        """Delete the staged tables of a run that owns them."""
        if not self._own:
            return
        jvm = self.spark._jvm
        for path, *_ in self._registry.values():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)
        self._registry.clear()
        self._stages.clear()
        self._memo.clear()

    def memo(self, name: str, build) -> DataFrame:
        """Build a (lazy) DataFrame once per run, so every use is the same
        plan and Spark reuses its exchange or subquery."""
        if name not in self._memo:
            self._memo[name] = build()
        return self._memo[name]
