"""Running item statistics over a growing log."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shortlist.operators.popularity import item_counts, smoothed_popularity, ucb_scores
from shortlist.session import shared_dir


def read_log(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def item_stats_stream(log: DataFrame, work_dir: str | None = None) -> DataFrame:
    """Drain the stream once and return the item statistics of everything read so far.

    The state is one (pos, total) pair per item. Each batch writes the complete table to shared
    storage, never to the driver. Running it again with the same ``work_dir`` goes on where the
    last run stopped.
    """
    spark = log.sparkSession
    base = work_dir or f"{shared_dir(spark)}/item-stats-{uuid.uuid4().hex}"
    # the statistics are a streaming aggregate: partial sums per task, then one state row per item
    counts = item_counts(log)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/table/batch={batch_id}")

    query = (
        counts.writeStream.outputMode("complete").foreachBatch(publish)
        .option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    tables = spark.read.schema("item_idx long, pos long, total long, batch long").parquet(f"{base}/table")
    last = tables.agg(F.max("batch")).first()[0]
    return tables.filter(F.col("batch") == last).drop("batch")


def streaming_scores(stats: DataFrame) -> DataFrame:
    """Smoothed share and confidence-bound score from the running statistics."""
    smooth = smoothed_popularity(stats).withColumnRenamed("relevance", "popularity")
    return ucb_scores(stats).withColumnRenamed("relevance", "ucb").join(smooth, "item_idx")
