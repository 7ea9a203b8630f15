"""Scratch tables, Arrow mapping and vectorised word hashing shared by the corpus operators."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: the white space of the word rule, as a Java character class body.
SPACE = r" \t-\r"
PIECE_BYTES = 1 << 21
MASK = (1 << 64) - 1

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_scratch: dict[tuple[str, str], tuple[SparkSession, list[str]]] = {}
_owners = [""]


@contextmanager
def scratch_of(owner: str) -> Iterator[None]:
    """What is saved within goes with ``release`` of this owner."""
    _owners.append(owner)
    try:
        yield
    finally:
        _owners.pop()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in ``spark.checkpoint.dir``; a temporary one only where that is unset (tests).

    It goes with ``release`` of its owner, or at the program's end.
    """
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="tessel-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base}/tessel-{uuid.uuid4().hex}/{name}"
    _scratch.setdefault((spark.sparkContext.applicationId, _owners[-1]), (spark, []))[1].append(path.rpartition("/")[0])
    return path


def save(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes ``df`` to the shared scratch folder and reads it back. The query's shuffle files go at its end."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``save`` returned, once nothing unwritten reads them."""
    for t in tables:
        jsc = t.sparkSession.sparkContext
        path = jsc._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(jsc._jsc.hadoopConfiguration()).delete(path, True)


def few(df: DataFrame, rows: int) -> DataFrame:
    """A saved table, marked to be sent out only if it has at most ``rows`` rows (small ones, by its caller's bound)."""
    return F.broadcast(df) if df.count() <= rows else df


def release(spark: SparkSession, owner: str) -> None:
    """Deletes the scratch tables of one owner. Its results that were not written yet and still read them are lost; others' are not."""
    _, paths = _scratch.pop((spark.sparkContext.applicationId, owner), (None, []))
    if spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _release_all() -> None:
    for (_, owner), (spark, _) in list(_scratch.items()):
        try:
            release(spark, owner)
        except Exception:  # the JVM may be gone at exit  # noqa: BLE001
            pass


def free_shuffles(spark: SparkSession) -> None:
    """Asks the JVM to collect finished queries, so that Spark's cleaner removes their shuffle files."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` of a function of one batch, called on slices whose strings stay near ``PIECE_BYTES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                if (out := f(piece)) is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    if not n:
        return
    per = max(1, int(PIECE_BYTES * n / max(1, batch.nbytes)))
    for i in range(0, n, per):
        yield batch.slice(i, per)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SEGMENT = 1 << 17
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, b, np.uint64)))) for b in (_BASE, _INVERSE)]
    return _powers


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the index of its first word (one more at the end)."""
    solid = ~_IS_SPACE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    edges = edges[solid[edges] & solid[edges - 1]]
    first[edges] = True
    last[edges - 1] = True
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def word_hashes(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of every row, row after row, and where each row begins in them."""
    data, offsets = utf8(column)
    starts, ends, rows = word_bounds(data, offsets)
    if lower:
        data = _LOWER[data]
    out, i, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SEGMENT, "right")))
        a, b = int(starts[i]), int(ends[j - 1])
        power, inverse = _power(max(b - a + 1, _SEGMENT + 1))
        sums = np.zeros(b - a + 1, np.uint64)
        np.cumsum(_TABLE[data[a:b]] * power[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        i = j
    return out, rows


def windows(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hashes of the k consecutive words from each position (the last k - 1 positions wrap around)."""
    out = h ^ np.uint64(seed)
    for i in range(1, k):
        out = out * np.uint64(_BASE) + np.roll(h, -i)
    return mix(out)


def row_of(rows: np.ndarray) -> np.ndarray:
    """For each word the number of its row."""
    return np.repeat(np.arange(len(rows) - 1), np.diff(rows))


def words_expr(text):
    """The number of words of a text column; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACE}]+")).cast("long")


def together(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """All rows of equal ``keys`` in one task, sorted by ``order``.

    Dealt by a hash of the keys: after a join on the keys themselves Spark would take a plain repartition by them for
    done, and its handling of skewed joins could then split one key's rows over tasks.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*keys)).sortWithinPartitions(*order)


def stream_by_shard(tables: DataFrame, rows: DataFrame, f: Callable, schema: str, partitions: int, row_bytes: int = 64 << 20) -> DataFrame:
    """Routes ``rows`` (shard, size, ...) to the entries of ``tables`` (shard, ...) of their shard, and streams them.

    A shard with many bytes of rows is split over as many tasks as ``row_bytes`` asks for, and its
    entries go to each of them, so a hot shard neither fills a task nor is dealt to one machine.
    ``f`` gets an iterator of (shard, entries as a pyarrow Table, iterator of row batches) and yields batches.
    Within a task only one shard's entries and one batch of rows are held.
    """
    both = [c for c in tables.columns if c != "shard"], [c for c in rows.columns if c not in ("shard", "size")]
    spread = save(rows.groupBy("shard").agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / row_bytes)).cast("int").alias("ways")), "ways")
    fill = lambda df, own, other: [F.lit(None).cast(other.schema[c].dataType).alias(c) for c in own]
    left = tables.join(spread, "shard").withColumn("way", F.explode(F.sequence(F.lit(0), F.col("ways") - 1))).select("shard", "way", F.lit(0).alias("kind"), *both[0], *fill(rows, both[1], rows))
    right = rows.join(spread, "shard").withColumn("way", F.pmod(F.xxhash64(*both[1][:1]), F.col("ways")).cast("int")).select("shard", "way", F.lit(1).alias("kind"), *fill(tables, both[0], tables), *both[1])
    dealt = together(left.unionByName(right), ["shard", "way"], ["shard", "way", "kind"], partitions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(_groups(batches, both))

    return dealt.mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], both: tuple[list[str], list[str]]) -> Iterator:
    def runs() -> Iterator[tuple[tuple[int, int, int], pa.RecordBatch]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(c)) for c in ("shard", "way", "kind")], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield tuple(keys[a].tolist()), batch.slice(a, b - a)

    source = runs()
    item = next(source, None)
    while item is not None:
        group, entries = item[0][:2], []
        while item is not None and item[0] == (*group, 0):
            entries.append(pa.RecordBatch.from_arrays([item[1].column(c) for c in both[0]], both[0]))
            item = next(source, None)

        def rest(group: tuple[int, int] = group) -> Iterator[pa.RecordBatch]:
            nonlocal item
            while item is not None and item[0] == (*group, 1):
                yield item[1].select(both[1])
                item = next(source, None)

        follow = rest()
        yield group[0], pa.Table.from_batches(entries) if entries else None, follow
        for _ in follow:
            pass
