"""Shards that arrive over time: a file source, the same batch plan per arrival, and a table that grows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def follow(spark: SparkSession, source: str, schema: str, change: Callable[[DataFrame], DataFrame], table: str, checkpoint: str, files_at_once: int = 1000) -> None:
    """Takes in all shards that ``source`` holds and were not yet taken; each batch of arrivals replaces its own folder, so a repeated batch adds nothing twice."""

    def add(df: DataFrame, batch: int) -> None:
        change(df).write.mode("overwrite").parquet(f"{table}/batch={batch}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
