"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shingles import text_runs
from tidemark.session import scratch_path

RUN_BYTES = 4 << 20  # of texts that a judge is given at once
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Separators of alphanumeric words: ASCII other than letters and digits (texts are lower-cased first).
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACED_WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(text: Column) -> Column:
    """A-Z to a-z and nothing else; NULL as the empty string.

    ``lower`` does the same when every character is one byte, and is faster.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, UPPER, LOWER))


def crc_mod(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def fresh_name(columns: list[str], stem: str) -> str:
    """``stem`` with as many underscores behind it as make it none of ``columns``."""
    taken = {c.lower() for c in columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh folder below the shared checkpoint folder and read it back.

    Cuts the lineage with files that every executor can reach, so a lost executor
    costs a re-read and not the work before.
    """
    path = scratch_path(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, label: str, limit: int = 8 << 20) -> DataFrame:
    """``df`` as the small side of a join: written, and broadcast where its rows take at most ``limit`` bytes.

    Beyond that the join is left to Spark. The size is that of the rows as JSON text, measured.
    """
    df = staged(df, label)
    size = df.select(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def rows_kept(docs: DataFrame, text_col: str, judge: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows of ``docs`` that a judge of texts keeps, all columns as they are.

    ``judge`` makes, once per task, a function from a list of texts to a list of booleans.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = judge()
        for batch in batches:
            for start, end, texts in text_runs(batch.column(text_col), RUN_BYTES):
                yield batch.slice(start, end - start).filter(pa.array(keep(texts), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def sql_lower(expr: str) -> str:
    """DuckDB form of ``lower_az``."""
    return f"translate(coalesce({expr}, ''), '{UPPER}', '{LOWER}')"
