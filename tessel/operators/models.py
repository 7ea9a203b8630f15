"""Pluggable models over Arrow batches: embedders and a top-k sparse autoencoder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def embed(rows: DataFrame, keys: list[str], text: str, make: Callable[[], Callable[[list[str]], np.ndarray]]) -> DataFrame:
    """keys + vector. ``make`` builds the embedder once per task; rows keep their keys, so order never matters."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            yield pdf[keys].assign(vector=list(model(pdf[text].fillna("").tolist())))

    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in keys)
    return rows.select(*keys, text).mapInPandas(run, f"{fields}, vector array<double>")


def hashing_embedder(dims: int = 16) -> Callable[[list[str]], np.ndarray]:
    """Counts of tokens by the first four hexadecimal digits of their MD5, for tests and baselines."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dims))
        for i, t in enumerate(texts):
            for w in t.split():
                out[i, int(hashlib.md5(w.encode()).hexdigest()[:4], 16) % dims] += 1  # noqa: S324
        return out

    return encode


def formula_weights(latents: int = 128, dims: int = 64) -> np.ndarray:
    """W[j, i] = ((j * 7919 + i * 104729 + j * i * 31) mod 201 - 100) / 100."""
    j, i = np.arange(latents)[:, None], np.arange(dims)[None, :]
    return ((j * 7919 + i * 104729 + j * i * 31) % 201 - 100) / 100.0


def sparse_encode(rows: DataFrame, key: str, vector: str, weights: np.ndarray, k: int, bias: np.ndarray | None = None, pre_bias: np.ndarray | None = None) -> DataFrame:
    """key + (top_acts, top_indices): the k largest of max((vector - pre_bias) weights + bias, 0), ties to the lower id; rows without a vector are left out.

    A matrix product finds the latents that may be among the k largest; theirs is then summed in the order of the
    dimensions, so neither the batch nor the library decides which of two nearly equal ones comes first.
    """
    add, less = (np.zeros(n) if x is None else x for x, n in ((bias, len(weights)), (pre_bias, weights.shape[1])))
    most, least = np.abs(weights).max(), min(k, len(weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf[vector]).astype(np.float64) - less
                acts = np.maximum(x @ weights.T + add, 0)
                error = 4 * np.finfo(float).eps * x.shape[1] * (np.abs(x).sum(1) * most + np.abs(add).max())
                row, latent = np.nonzero(acts >= (np.partition(acts, -least, axis=1)[:, -least] - error)[:, None])
                total = np.zeros(len(row))
                for i in range(x.shape[1]):
                    total += x[row, i] * weights[latent, i]
                acts[row, latent] = np.maximum(total + add[latent], 0)
                top = np.argsort(-acts, axis=1, kind="stable")[:, :k]
                yield pd.DataFrame({key: pdf[key], "top_acts": list(np.take_along_axis(acts, top, 1)), "top_indices": list(top.astype(np.float64))})

    return rows.where(F.col(vector).isNotNull()).select(key, vector).mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, top_acts array<double>, top_indices array<double>")


def stack(rows: DataFrame, shard: str, position: str, vector: str, block: int = 4096) -> DataFrame:
    """(shard, block, first, rows, width, matrix): the vectors of ``block`` consecutive positions as one little-endian float32 matrix; null vectors are left out."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position")
        x = np.stack(pdf["vector"]).astype("<f4")
        return pd.DataFrame({shard: pdf[shard].iloc[:1], "block": pdf["block"].iloc[:1], "first": pdf["position"].iloc[:1], "rows": [len(x)], "width": [x.shape[1]], "matrix": [x.tobytes()]})

    some = rows.where(F.col(vector).isNotNull()).select(shard, F.floor(F.col(position) / block).alias("block"), F.col(position).cast("long").alias("position"), F.col(vector).alias("vector"))
    return some.groupBy(shard, "block").applyInPandas(run, f"`{shard}` {rows.schema[shard].dataType.simpleString()}, block long, first long, rows long, width long, matrix binary")


def codes(encoded: DataFrame, key: str) -> DataFrame:
    """key, feature, activation: a row per latent of a row."""
    pairs = F.arrays_zip(F.transform("top_indices", lambda x: x.cast("long")).alias("feature"), F.col("top_acts").alias("activation"))
    return encoded.select(key, F.inline(pairs).alias("feature", "activation"))
