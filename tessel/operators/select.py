"""Top rows per group, positional joins and their guard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n of each group; Spark limits groups before the shuffle and after it."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def top_n_two_phase(rows: DataFrame, shard: str, by: list[str], order: list[Column], local: int, final: int) -> DataFrame:
    """Loses rows where a shard holds more than ``local`` of a group's ``final`` best; ``top_n`` doesn't."""
    return top_n(top_n(rows, [shard, *by], order, local), by, order, final)


def top_n_filled(codes: DataFrame, rows: DataFrame, features: DataFrame, key: str, n: int) -> DataFrame:
    """Top n of each feature, filled up with rows of activation 0 (smallest keys first) where fewer have it.

    Only the n + hits smallest keys can fill a group of fewer than n hits, so the fill joins 2n keys, not all.
    """
    hits = top_n(codes.where("activation > 0"), ["feature"], [F.desc("activation"), F.col(key)], n)
    few = features.join(hits.groupBy("feature").agg(F.count("*").alias("n")), "feature", "left").where(F.coalesce("n", F.lit(0)) < n).select("feature")
    fill = few.crossJoin(F.broadcast(rows.select(key).orderBy(key).limit(2 * n)))  # 2n rows
    fill = fill.join(hits, ["feature", key], "left_anti").withColumn("activation", F.lit(0.0))
    return top_n(hits.select("feature", key, "activation").unionByName(fill), ["feature"], [F.desc("activation"), F.col(key)], n)


def with_position(rows: DataFrame, shard: str, key: str) -> DataFrame:
    """row_pos from 0 within the shard, by a total order; files have it already as ``_metadata.row_index``."""
    return rows.withColumn("row_pos", (F.row_number().over(Window.partitionBy(shard).orderBy(key)) - 1).cast("long"))


def with_total_position(rows: DataFrame, key: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """row_pos from 0 over all rows of all files, by a numeric key (nulls last), then by ``ties``.

    Ranges of the key, of about as many rows each, are numbered beside each other, so no task gets all rows. A range
    follows from the key alone: quantiles need only be near, and repeated keys stay together.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = np.unique(rows.approxQuantile(key, [i / n for i in range(1, n)], 0.25 / n)) if n > 1 else np.empty(0)

    @F.pandas_udf("int")
    def part(x: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, x, side="right"))

    parted = rows.withColumn("_part", part(key))
    sizes = np.zeros(len(bounds) + 1, dtype=np.int64)
    for r in parted.groupBy("_part").agg(F.count("*").alias("n")).collect():  # n rows at most
        sizes[r._part] = r.n
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.asc_nulls_last(key), *ties))
    return parted.withColumn("row_pos", F.get(F.lit(np.cumsum(sizes) - sizes), F.col("_part")) + within - 1).drop("_part")


def zip_by_position(*parts: DataFrame, on: tuple[str, str] = ("shard", "row_pos"), check: bool = True) -> DataFrame:
    """Rows of the same shard and position side by side. With ``check`` a shard with unequal numbers of rows is an error: nothing is dropped without a word."""
    if check:
        counts = zip_guard({f"part {i}": p for i, p in enumerate(parts)}, on[0])
        if bad := counts.where("not equal").take(1):
            raise ValueError(f"parts differ in their rows: {bad[0].asDict()}")
    out = parts[0]
    for p in parts[1:]:
        out = out.join(p, list(on))
    return out


def lookup(requests: DataFrame, rows: DataFrame, order: str, on: tuple[str, str] = ("shard", "row_pos")) -> DataFrame:
    """For each request (order, shard, row_pos, ...) the row at that place, in the requests' order: repeated requests give repeated rows, those to nowhere nulls."""
    return requests.join(rows, list(on), "left").orderBy(order)


def zip_guard(parts: dict[str, DataFrame], shard: str = "shard") -> DataFrame:
    """shard, rows of each part, equal: shards to check before a zip."""
    out = None
    for name, p in parts.items():
        n = p.groupBy(shard).agg(F.count("*").alias(name))
        out = n if out is None else out.join(n, shard, "full")
    out = out.select(shard, *(F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in parts))
    first, *rest = parts
    equal = F.lit(True)
    for c in rest:
        equal = equal & (F.col(f"`{first}`") == F.col(f"`{c}`"))
    return out.withColumn("equal", equal)
