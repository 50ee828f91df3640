"""D12 as a stream: append newly landed weekly scores to the history.

Each weekly run lands its score rows (date + measures) as parquet files in a
landing folder. A Structured Streaming query picks up new files, and each
micro-batch appends only the dates newer than the history's newest, the rule of
the batch (``operators.composite.append_newer``), so

* history rows are never rewritten (the overview is append-only, T11);
* replaying a batch after a failure - a lost executor or a restarted
  driver - appends nothing twice: offsets and commits live in the
  checkpoint folder, and a date that is there is not newer than the newest.

``trigger(availableNow=True)`` processes whatever has landed and stops,
which fits a weekly schedule; a continuous trigger works unchanged.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.composite import newer_than
from tidemark.session import checkpoint_root

LANDED = "_landed"


def _has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one parquet file."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getContentSummary(p).getFileCount() > 0


def _append_new(history_path: str, key: str, upto):
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # several versions of a week: the one that landed last
        rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col(LANDED).desc(), F.xxhash64("*").desc()))
        fresh = batch.withColumn("_rank", rank).where("_rank = 1").drop("_rank", LANDED)
        if _has_data(spark, history_path):   # first batch: nothing to compare with
            newest = spark.read.parquet(history_path).agg(F.max(key)).first()[0]
            fresh = newer_than(fresh, key, F.lit(newest))
        if upto is not None:
            fresh = fresh.where(F.col(key) <= F.lit(upto))
        fresh.write.mode("append").parquet(history_path)
    return run


def start_history_append(spark: SparkSession, landing: str, history: str, schema: StructType,
                         key: str = "date", checkpoint: str | None = None, upto=None,
                         available_now: bool = True) -> StreamingQuery:
    """Start the append stream from ``landing`` into ``history`` (parquet).

    ``upto`` is the last date to take (the analysis week). The default checkpoint is
    that of this landing and history, so several streams do not share one."""
    if checkpoint is None:
        pair = hashlib.sha256(f"{landing}\n{history}".encode()).hexdigest()[:16]
        checkpoint = os.path.join(checkpoint_root(spark), "streams", f"history_append-{pair}")
    stream = (spark.readStream.schema(schema).parquet(landing)
              .select("*", F.col("_metadata.file_modification_time").alias(LANDED)))
    w = (stream.writeStream.foreachBatch(_append_new(history, key, upto))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
