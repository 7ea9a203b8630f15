"""Packing of rows into batches under a budget of padded tokens, padding and masks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def pack(chunks: DataFrame, limit: int, prefix: int, shard: str, keys: list[str]) -> DataFrame:
    """shard, keys, n, batch_id: next-fit in ascending length, where a batch costs its longest row times its rows.

    Rows of one length differ only by their place among them, so the scan goes over a shard's counts of
    lengths, and each row finds its batch from where its length begins. No task holds a shard's rows: they
    are ranked within a length by Spark's own sort. A row over the limit is a batch of its own, and no empty
    batch comes before it.
    """
    rows = chunks.select(shard, *keys, (F.col("chunk_token_count") + prefix).alias("n"))

    def next_fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("n")
        batch, k, out = 0, 0, []
        for n, count in zip(pdf["n"].tolist(), pdf["count"].tolist(), strict=True):
            most = max(1, limit // n) if n > 0 else k + count
            room = max(0, most - k)
            out.append((batch, room, most))
            if count <= room:
                k += count
            else:
                full, over = divmod(count - room - 1, most)
                batch, k = batch + 1 + full, over + 1
        first, room, most = zip(*out, strict=True)
        return pdf.drop(columns="count").assign(first=first, room=room, most=most)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(shard, "n").schema)
    starts = rows.groupBy(shard, "n").count().groupBy(shard).applyInPandas(next_fit, f"{fields}, first long, room long, most long")
    ranked = rows.withColumn("_place", F.row_number().over(Window.partitionBy(shard, "n").orderBy(*keys)) - 1)
    later = F.col("first") + 1 + F.floor((F.col("_place") - F.col("room")) / F.col("most"))
    batch = F.when(F.col("_place") < F.col("room"), F.col("first")).otherwise(later).cast("long")
    starts = starts.withColumnsRenamed({shard: "_shard", "n": "_n"})
    return ranked.join(starts, F.col(shard).eqNullSafe(F.col("_shard")) & F.col("n").eqNullSafe(F.col("_n"))).select(shard, *keys, "n", batch.alias("batch_id"))


def pad(rows: DataFrame, by: list[str], tokens: str) -> DataFrame:
    """Token lists filled with 0 to the longest of their batch, with a mask of 1 for tokens."""
    n = F.size(tokens)
    gap = F.max(n).over(Window.partitionBy(*by)) - n
    return rows.withColumn("_gap", gap).withColumn("mask", F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.col("_gap")))).withColumn(tokens, F.concat(tokens, F.array_repeat(F.lit(0), F.col("_gap")))).drop("_gap")


def fixed_batches(rows: DataFrame, size: int, shard: str, key: str) -> DataFrame:
    return rows.withColumn("batch_id", F.floor((F.row_number().over(Window.partitionBy(shard).orderBy(key)) - 1) / size).cast("long"))
