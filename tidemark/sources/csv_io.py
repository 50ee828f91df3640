"""CSV landing and publishing.

Landed files are read with a declared schema (no inference pass over the
data) and ``NA`` as the null token, in splits unless the caller says that quoted
cells hold line breaks (``multi_line``). Written files use ISO dates and ``NA`` for NULL.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import scratch_path

# Compact type codes of the reference's CSV reads, one letter per column.
TYPE_CODES = {
    "i": T.IntegerType(), "d": T.DoubleType(), "D": T.DateType(), "c": T.StringType(),
    "l": T.BooleanType(), "n": T.LongType(),
}


def schema_from_codes(names: Sequence[str], codes: str) -> T.StructType:
    """``("date", "n"), "Dn"`` -> StructType(date DATE, n BIGINT)."""
    if len(names) != len(codes):
        raise ValueError(f"{len(names)} names but {len(codes)} type codes")
    return T.StructType([T.StructField(n, TYPE_CODES[c], True) for n, c in zip(names, codes)])


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str, multi_line: bool = False) -> DataFrame:
    """Landed CSV with a declared schema (header, NA as NULL, ISO dates).

    ``multi_line`` is for files whose quoted cells or headers hold line breaks; such a
    file cannot be split, so each is one task."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", multi_line)
            .option("nullValue", "NA").option("emptyValue", None)
            .option("dateFormat", "yyyy-MM-dd").option("mode", "FAILFAST")
            .csv(path))


class TooManyRejects(ValueError):
    """More rows than allowed do not fit the declared schema."""


REJECTED = "_rejected"


def read_csv_with_rejects(spark: SparkSession, path: str, schema: T.StructType, rejects: str, max_rejects: int,
                          multi_line: bool = False) -> tuple[DataFrame, int]:
    """A landed CSV with a declared schema and the number of rows that do not fit it.

    Every row is parsed once, whatever columns are used later, and written to the shared folder;
    the rows that fit come from there. The others go to ``rejects`` (Parquet: file, raw line). More than
    ``max_rejects`` of them raise ``TooManyRejects``: the reject table is there, no row comes back."""
    parsed = (spark.read.schema(T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())]))
              .option("header", True).option("multiLine", multi_line).option("nullValue", "NA").option("emptyValue", None)
              .option("dateFormat", "yyyy-MM-dd").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED)
              .option("columnPruning", False).csv(path))
    counted = Observation()
    landed = scratch_path(spark, "landed")
    (parsed.withColumn("_file", F.col("_metadata.file_path")).observe(counted, F.count(REJECTED).alias("n"))
     .write.parquet(landed))
    rows, n = spark.read.parquet(landed), counted.get["n"]
    rows.where(F.col(REJECTED).isNotNull()).select(F.col("_file").alias("file"), F.col(REJECTED).alias("line")).write.mode("overwrite").parquet(rejects)
    if n > max_rejects:
        raise TooManyRejects(f"{n} rows of {path} do not fit the schema, {max_rejects} are allowed; see {rejects}")
    return rows.where(F.col(REJECTED).isNull()).drop(REJECTED, "_file"), n


def read_text_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Every column as text (portal CSVs); cast later with ``try_cast``."""
    return (spark.read.option("header", True).option("multiLine", multi_line)
            .option("inferSchema", False).csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              partition_by: Sequence[str] = ()) -> None:
    """CSV with header, NA for NULL and ISO dates; optional partition columns."""
    w = (df.write.mode(mode).option("header", True).option("nullValue", "NA")
         .option("dateFormat", "yyyy-MM-dd"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def read_matrix_csv(spark: SparkSession, path: str, first_id: str) -> DataFrame:
    """A landed spreadsheet matrix (ids + one column per period) whose header
    row sits below title rows, as sheets exported to CSV often do.

    Spark's CSV reader cannot skip leading lines. The header row is the first line
    that starts with ``first_id``; its cells name the columns and fix the width, so
    a title may be padded or not. Exactly the lines up to the header are dropped, by
    their place in the file; a row whose cells are all empty stays. Raises when there
    is no such line or it has one cell. Values stay text; cast them after melting."""
    lines = spark.read.text(path)
    start = F.regexp_replace("value", "^[\ufeff\"]+", "")
    header = lines.where(start.startswith(first_id)).first()
    if header is None:
        raise ValueError(f"no header row starting with {first_id!r} in {path}")
    names = next(csv.reader([header["value"].lstrip("\ufeff")]))
    if len(names) < 2:
        raise ValueError(f"the header row of {path} has one cell; expected ids and periods")
    names = [n if n else f"_blank{i}" for i, n in enumerate(names)]
    raw = (spark.read.schema(", ".join(f"c{i} STRING" for i in range(len(names))))
           .option("header", False).csv(path))
    # partitions of one file are in file order, and so are these numbers
    raw = raw.withColumn("_row", F.monotonically_increasing_id())
    at = raw.where(F.regexp_replace("c0", "^\ufeff", "") == first_id).agg(F.min("_row")).scalar()
    return raw.where(F.col("_row") > at).drop("_row").toDF(*names)
