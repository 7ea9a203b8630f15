"""Sources and sinks: sharded corpora, raw float32 matrices, Arrow files, re-sharding, publishing with retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, path: str, text_key: str = "text", keep: tuple[str, ...] = (), shards: list[str] | None = None, n: int | None = None) -> DataFrame:
    """text, keep columns, shard (file name) and row_pos (position in it) of a Parquet directory, glob or file.

    ``shards`` picks files by name; ``n`` is a lazy head. A leftover ``__index_level_0__`` is never read.
    """
    reader = spark.read.option("pathGlobFilter", "*.parquet") if not path.endswith(".parquet") else spark.read
    df = reader.parquet(path).select(F.col(text_key).alias("text"), *keep, F.col("_metadata.file_name").alias("shard"), F.col("_metadata.row_index").alias("row_pos"))
    df = df.where(F.col("shard").isin(shards)) if shards is not None else df
    return df.limit(n) if n is not None else df


def read_arrow(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Arrow IPC files (stream or file format), a file per row of ``binaryFile``; keep files to a worker's memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("content"):
                raw = data.as_py()
                source = pa.ipc.open_file(raw) if raw.startswith(b"ARROW1") else pa.ipc.open_stream(raw)
                yield from source.read_all().to_batches()

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def read_f32(spark: SparkSession, path: str, dims: int) -> DataFrame:
    """(shard, row_pos, vector) of headerless little-endian float32 matrices; a partial last row is ignored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"], strict=True):
                x = np.frombuffer(raw[: len(raw) // (4 * dims) * 4 * dims], "<f4").reshape(-1, dims)
                yield pd.DataFrame({"shard": name.rpartition("/")[2], "row_pos": np.arange(len(x)), "vector": list(x)})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "shard string, row_pos long, vector array<float>")


def write_f32(rows: DataFrame, folder: str, header: bool = False) -> DataFrame:
    """Writes (shard, row_pos, vector) as a float32 matrix per shard, raw or with ``header`` as a .npy tensor, to a folder that all executors mount; gives (shard, rows).

    Positions must be 0 to n - 1: holes are an error, not zero rows. A task writes under a name of its own
    and renames at the end, so a retried task leaves one whole file.
    """

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        import os
        import uuid

        pdf = pdf.sort_values("row_pos")
        if pdf["row_pos"].tolist() != list(range(len(pdf))):
            raise ValueError(f"positions of shard {pdf['shard'].iloc[0]} are not 0 to {len(pdf) - 1}")
        os.makedirs(folder, exist_ok=True)
        to = f"{folder}/{pdf['shard'].iloc[0]}.npy"
        matrix = np.stack(pdf["vector"]).astype("<f4")
        with open(part := f"{to}.{uuid.uuid4().hex}", "wb") as f:
            if header:
                np.lib.format.write_array(f, matrix)
            else:
                matrix.tofile(f)
        os.replace(part, to)
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "rows": [len(pdf)]})

    return rows.select(F.col("shard").cast("string").alias("shard"), "row_pos", "vector").groupBy("shard").applyInPandas(write, "shard string, rows long")


def shard_names(template: str, n: int) -> list[str]:
    """The names of n shards, by a template such as ``data-{i:05d}-of-{n:05d}.parquet``."""
    return [template.format(i=i, n=n) for i in range(n)]


def list_shards(spark: SparkSession, folder: str, suffix: str = "") -> list[str]:
    """The names of the files of a folder of any store, sorted; hidden ones are left out."""
    p, fs = _fs(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()]
    return sorted(x for x in names if x.endswith(suffix) and not x.startswith(("_", ".")))


def fetch_shard(spark: SparkSession, folder: str, name: str, to: str, arrow: bool = False) -> str:
    """One shard's file for the caller: copied as it is, or as an Arrow file. A shard is a file, so the caller holds no more than that."""
    if not arrow:
        copy(spark, f"{folder}/{name}", f"file:{to}")
        return to
    with pa.OSFile(to, "wb") as sink:
        table = spark.read.parquet(f"{folder}/{name}").toArrow()
        with pa.ipc.new_file(sink, table.schema) as writer:
            writer.write_table(table)
    return to


def reuse(spark: SparkSession, path: str, build: Callable[[], DataFrame], fresh: bool = False) -> DataFrame:
    """The table at ``path`` if it was written whole before (or ``fresh`` asks for a new one), else what ``build`` gives, written there."""
    p, fs = _fs(spark, f"{path}/_SUCCESS")
    if fresh or not fs.exists(p):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def for_each_shard(names: list[str], job: Callable[[str], object], collect_errors: bool = False, attempts: int = 1, at_once: int = 4) -> tuple[dict[str, object], dict[str, Exception]]:
    """Runs a Spark job per shard, some at once, in any order: (results, errors) by name.

    Each is tried ``attempts`` times. The first shard that fails for good is raised, and shards not yet begun are
    left, unless ``collect_errors`` asks to go on and to be told.
    """
    from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

    def run(name: str) -> object:
        out: list = []
        publish(lambda: out.append(job(name)), attempts, 0)
        return out[0]

    with ThreadPoolExecutor(at_once) as pool:
        jobs = {name: pool.submit(run, name) for name in names}
        wait(jobs.values(), return_when="ALL_COMPLETED" if collect_errors else FIRST_EXCEPTION)
        failed = {n: f.exception() for n, f in jobs.items() if f.done() and not f.cancelled() and f.exception()}
        if failed and not collect_errors:
            for f in jobs.values():
                f.cancel()
            raise next(iter(failed.values()))
    return {n: f.result() for n, f in jobs.items() if n not in failed}, failed


def publish_table(df: DataFrame, path: str, shards: int = 99, attempts: int = 20, wait: float = 5.0) -> int:
    """Writes ``df`` as exactly ``shards`` files beside ``path``, then copies the tree there, again after failures; gives the attempts used."""
    spark, staged = df.sparkSession, f"{path}.staged"
    reshard(df, shards, staged, "overwrite")

    def send() -> None:
        remove(spark, [path])
        copy(spark, staged, path)

    used = publish(send, attempts, wait)
    remove(spark, [staged])
    return used


def reshard(df: DataFrame, n: int, path: str, mode: str = "error") -> None:
    df.repartition(n).write.mode(mode).parquet(path)


def write_sharded(df: DataFrame, path: str, shard: str = "shard", mode: str = "overwrite") -> None:
    """``overwrite`` replaces only the shards in ``df``; ``append`` adds to them."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(shard).parquet(path)


def replace_table(spark: SparkSession, path: str, change: Callable[[DataFrame], DataFrame]) -> None:
    """Filters a table "in place": writes beside it, then swaps names; the input is never written over while read."""
    change(spark.read.parquet(path)).write.mode("overwrite").parquet(f"{path}.new")
    move(spark, path, f"{path}.old")
    move(spark, f"{path}.new", path)
    remove(spark, [f"{path}.old"])


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def move(spark: SparkSession, a: str, b: str) -> None:
    p, fs = _fs(spark, a)
    if not fs.rename(p, _fs(spark, b)[0]):
        raise OSError(f"{a} can't be renamed to {b}")


def copy(spark: SparkSession, a: str, b: str) -> None:
    (p, fs), (q, to) = _fs(spark, a), _fs(spark, b)
    spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, p, to, q, False, spark.sparkContext._jsc.hadoopConfiguration())


def remove(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        p, fs = _fs(spark, path)
        fs.delete(p, True)


def publish(send: Callable[[], None], attempts: int = 20, wait: float = 5.0) -> int:
    """Calls ``send`` until it succeeds, at most ``attempts`` times, and raises its last error; gives the attempts used."""
    for k in range(1, attempts + 1):
        try:
            send()
            return k
        except Exception:
            if k == attempts:
                raise
            time.sleep(wait)
    raise ValueError("no attempts")
