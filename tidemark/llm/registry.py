"""Queries of the training-data operators: name -> callable(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("lm", "tokens", "mixing", "fingerprints", "urls", "language", "quality", "dedup", "decontam", "licenses", "manifest", "alignment",
           "neighbours")


def _modules():
    return [import_module(f"tidemark.llm.{m}") for m in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {m.NAME: m.query for m in _modules()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {m.NAME: m.SQL for m in _modules() if m.SQL is not None}
