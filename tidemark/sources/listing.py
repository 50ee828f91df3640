"""Folders as tables: one row per file, listed by Spark without reading any content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATED = r"(\d{4}-\d{2}-\d{2})"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def file_listing(spark: SparkSession, *paths: str, pattern: str | None = None) -> DataFrame:
    """path, length, modified and the columns of ``_metadata`` for every data file below ``paths``.

    Spark lists the folders (on the executors where there are many) and, as no content column is asked
    for, opens no file. Files whose names start with ``_`` or ``.`` are left out, as in any read.
    ``pattern`` is a glob for file names."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(list(paths)).select(
        "path", "length", F.col("modificationTime").alias("modified"),
        *[F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_name", "file_size", "file_modification_time")])


def date_in(path: Column, before: str = "", after: str = "") -> Column:
    """The date that stands in a path between two literal texts, NULL without one or if it is no date."""
    quoted = lambda s: "".join("\\" + c if not c.isalnum() else c for c in s)
    found = F.regexp_extract(path, quoted(before) + DATED + quoted(after), 1)
    return F.try_to_date(F.nullif(found, F.lit("")))


def newest_dated(spark: SparkSession, path: str, before: str = "", after: str = "", pattern: str | None = None) -> DataFrame:
    """One row: latest, the newest period that the names of the files below ``path`` carry, and files,
    the number of dated ones."""
    names = file_listing(spark, path, pattern=pattern).select(date_in(F.col("path"), before, after).alias("period"))
    return names.agg(F.max("period").alias("latest"), F.count("period").alias("files"))
