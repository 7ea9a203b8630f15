"""Exact and approximate vector search: an inverted-file index with optional product quantisation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessel.functions.vectors import dot, normalize
from tessel.operators.select import top_n

SAMPLE_ROWS = 20_000  # the most vectors that centroids are fitted on; every row is indexed
BROADCAST_QUERIES = 20_000  # rows of queries and lists that are sent to the index; more are joined


def nearest(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, block: int = 1000) -> DataFrame:
    """(query, key, score): for each of ``queries`` the k rows of the largest dot product, ties to the smaller key.

    Queries are a stated set: they are sent to the rows in blocks of ``block``; each task keeps k rows a query.
    """
    asked = queries.where(F.col(vector).isNotNull()).select(F.col(key).alias("query"), F.col(vector).alias("_q"))
    blocks, out = max(1, -(-asked.count() // block)), None
    numbered = asked.withColumn("_block", F.ntile(blocks).over(Window.orderBy("query"))) if blocks > 1 else asked.withColumn("_block", F.lit(1))
    for i in range(1, blocks + 1):
        met = rows.where(F.col(vector).isNotNull()).crossJoin(F.broadcast(numbered.where(F.col("_block") == i).drop("_block")))
        best = top_n(met.select("query", key, dot(F.col(vector), F.col("_q")).alias("score")), ["query"], [F.desc("score"), F.col(key)], k)
        out = best if out is None else out.unionByName(best)
    return out


def kmeans(x: np.ndarray, k: int, seed: int = 0, rounds: int = 15) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = ((x**2).sum(1)[:, None] - 2 * x @ c.T + (c**2).sum(1)).argmin(1)
        c = np.stack([x[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
    return c


def fit_sample(rows: DataFrame, key: str, vector: str) -> np.ndarray:
    part = min(1.0, SAMPLE_ROWS / max(1, rows.count()))
    drawn = rows.where((F.pmod(F.xxhash64(key), F.lit(1_000_003)) < part * 1_000_003) & F.col(vector).isNotNull()).select(vector).limit(SAMPLE_ROWS).toPandas()
    x = np.stack(drawn[vector]).astype(np.float64)
    return _unit(x)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _listed(rows: DataFrame, key: str, vector: str, n: int, centroids: np.ndarray, codebooks: list[np.ndarray] | None = None) -> DataFrame:
    """(id, list, v): each row in its n nearest lists, with its unit vector, or with ``codebooks`` that of its quantised parts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = _unit(np.stack(pdf[vector]).astype(np.float64))
                near = np.argsort(-(x @ centroids.T - (centroids**2).sum(1) / 2), axis=1, kind="stable")[:, :n]
                if codebooks is not None:
                    parts = np.split(x, len(codebooks), axis=1)
                    x = np.concatenate([c[((p**2).sum(1)[:, None] - 2 * p @ c.T + (c**2).sum(1)).argmin(1)] for p, c in zip(parts, codebooks, strict=True)], 1)
                yield pd.DataFrame({"id": np.repeat(pdf[key].to_numpy(), near.shape[1]), "list": near.ravel(), "v": [v for v in x for _ in range(near.shape[1])]})

    return rows.where(F.col(vector).isNotNull()).select(key, vector).mapInPandas(run, "id long, list long, v array<double>")


def _best(asked: DataFrame, indexed: DataFrame, rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, shortlist: int) -> DataFrame:
    """Queries are the stated set, so they are sent to the lists if they are few; hot lists stay where they are."""
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_QUERIES else asked
    met = indexed.alias("r").join(asked.alias("q"), F.col("q.list") == F.col("r.list")).select(F.col("q.id").alias("query"), F.col("r.id").alias(key), dot(F.col("q.v"), F.col("r.v")).alias("score"))
    order = [F.desc("score"), F.col(key)]
    if shortlist <= k:
        return top_n(met, ["query"], order, k)
    full = lambda df, name, v: df.where(F.col(vector).isNotNull()).select(F.col(key).alias(name), normalize(F.col(vector)).alias(v))
    near = top_n(met, ["query"], order, shortlist).select("query", key)
    again = near.join(full(rows, key, "_x"), key).join(full(queries, "query", "_y"), "query")
    return top_n(again.select("query", key, dot(F.col("_x"), F.col("_y")).alias("score")), ["query"], order, k)


def exact_search(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(query, key, score) by cosine over all rows, which stay where they are."""
    unit = lambda df: df.where(F.col(vector).isNotNull()).select(key, normalize(F.col(vector)).alias(vector))
    return nearest(unit(rows), unit(queries), key, vector, k)


def build_index(rows: DataFrame, key: str, vector: str, path: str, lists: int | None = None, sub_vectors: int | None = None, codes: int = 256) -> None:
    """Stores an inverted-file index by cosine under ``path``: every row in the folder of its list, quantised to ``sub_vectors`` parts if given, with its centroids and codebooks.

    Lists are the root of the number of rows unless given. Centroids and codebooks are fitted on at most ``SAMPLE_ROWS`` rows.
    """
    spark, x = rows.sparkSession, fit_sample(rows, key, vector)
    centroids = kmeans(x, lists or max(1, int(rows.count() ** 0.5)))
    books = [kmeans(p, codes) for p in np.split(x, sub_vectors, axis=1)] if sub_vectors else []
    fitted = [(-1, i, c.tolist()) for i, c in enumerate(centroids)] + [(b, i, c.tolist()) for b, book in enumerate(books) for i, c in enumerate(book)]
    spark.createDataFrame(fitted, "book int, i int, v array<double>").coalesce(1).write.mode("overwrite").parquet(f"{path}/fitted")
    _listed(rows, key, vector, 1, centroids, books or None).write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")


def search_index(spark: SparkSession, path: str, rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, probes: int | None = None, shortlist: int = 0) -> DataFrame:
    """(query, key, score) from a stored index: the best k among the rows of each query's ``probes`` nearest lists (all if not given).

    The best ``shortlist`` by their quantised vectors (if more than k) are scored once more by their full ones.
    """
    fitted = spark.read.parquet(f"{path}/fitted").toPandas().sort_values(["book", "i"])  # centroids and codebooks only
    centroids = np.stack(fitted[fitted.book == -1]["v"])
    asked = _listed(queries, key, vector, min(probes or len(centroids), len(centroids)), centroids)
    indexed = spark.read.schema("id long, v array<double>, list long").parquet(f"{path}/lists")
    return _best(asked, indexed, rows, queries, key, vector, k, shortlist)


def ivf_search(rows: DataFrame, queries: DataFrame, key: str, vector: str, k: int, probes: int, centroids: np.ndarray, codebooks: list[np.ndarray] | None = None, shortlist: int = 0) -> DataFrame:
    """(query, key, score): the best k for each query among the rows of its ``probes`` nearest lists, by cosine, without a stored index.

    With ``codebooks`` rows are scored by their quantised parts, and the best ``shortlist`` of them (if more than k) once more by their full vectors.
    """
    indexed, asked = _listed(rows, key, vector, 1, centroids, codebooks), _listed(queries, key, vector, probes, centroids)
    return _best(asked, indexed, rows, queries, key, vector, k, shortlist if codebooks is not None else 0)


def build_label_index(codes: DataFrame, key: str, label: str, path: str, buckets: int = 16) -> None:
    """Stores label -> keys: a row per label and key, sorted by label within the folder of the label's bucket, so a lookup reads few row groups."""
    rows = codes.select(label, key).distinct().withColumn("bucket", F.pmod(F.xxhash64(label), F.lit(buckets)).cast("int"))
    rows.repartition("bucket", F.pmod(F.xxhash64(key), F.lit(8))).sortWithinPartitions("bucket", label, key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def lookup_labels(spark: SparkSession, path: str, label: str, wanted: list, buckets: int = 16) -> DataFrame:
    """The index's rows of the wanted labels, from their buckets' folders only."""
    folders = spark.createDataFrame([(x,) for x in wanted], f"{label} long").select(F.pmod(F.xxhash64(label), F.lit(buckets)).cast("int").alias("b")).distinct().collect()
    return spark.read.parquet(path).where(F.col("bucket").isin([r.b for r in folders]) & F.col(label).isin(wanted)).drop("bucket")


def recall(found: DataFrame, exact: DataFrame, key: str) -> DataFrame:
    both = exact.join(found.select("query", key, F.lit(1).alias("hit")), ["query", key], "left")
    return both.agg(F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall"), F.count("*").alias("pairs"))
