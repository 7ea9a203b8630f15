"""Line dedup: a sharded minimal perfect hash over the hashes of all distinct lines, with fingerprint and count arrays that documents probe."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import discard, map_batches, mix, save, stream_by_shard

MIN_CHARS, MIN_DOCS, SHARD_KEYS = 20, 3, 1 << 16
_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(_SPACE).lower()


def line_hash(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """Two 64-bit halves of a digest of the line's key; None if the key is shorter than ``min_chars`` code points."""
    if len(line) < min_chars or len(key := line_key(line)) < min_chars or len(key) < 4 * min_chars and len(key.decode()) < min_chars:
        return None
    d = hashlib.blake2b(key, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def hashes_of(texts: list[str | None], min_chars: int) -> tuple[list[list[bytes]], list[int], list[int], list[int], list[int]]:
    """The lines of each text; row, line number and the two halves of each long line."""
    lines, row, at, h1, h2 = [], [], [], [], []
    for r, text in enumerate(texts):
        own = (text or "").encode().split(b"\n")
        lines.append(own)
        for i, line in enumerate(own):
            if (h := line_hash(line, min_chars)) is not None:
                row.append(r)
                at.append(i)
                h1.append(h[0])
                h2.append(h[1])
    return lines, row, at, h1, h2


class PerfectHash:
    """Minimal perfect hash of distinct 128-bit keys: on each level a key owns the slot no other key falls in; the rest goes on."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray) -> None:
        keys = self._key(h1, h2)
        self.levels: list[np.ndarray] = []
        while len(keys):
            size = max(64, 2 * len(keys))
            slot = self._slot(keys, len(self.levels), size)
            single = np.bincount(slot, minlength=size) == 1
            self.levels.append(single)
            keys = keys[~single[slot]]
        self._rank()

    @staticmethod
    def _key(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        return h1.view(np.uint64) ^ mix(h2.view(np.uint64))

    @staticmethod
    def _slot(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys + np.uint64(0x632BE59BD9B4E019 * (level + 1) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    def _rank(self) -> None:
        self.ranks, n = [], 0
        for bits in self.levels:
            self.ranks.append(np.cumsum(bits, dtype=np.int32) - 1 + n)  # of one shard at a time
            n += int(bits.sum())
        self.n = n

    def index(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """0 to n - 1 for known keys, each its own; for others any index or -1."""
        keys = self._key(h1, h2)
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, rank) in enumerate(zip(self.levels, self.ranks, strict=True)):
            slot = self._slot(keys[left], level, len(bits))
            hit = bits[slot]
            out[left[hit]] = rank[slot[hit]]
            left = left[~hit]
        return out

    def dump(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(np.packbits(x).tobytes() for x in self.levels)

    @classmethod
    def load(cls, data: bytes) -> PerfectHash:
        self, n = cls.__new__(cls), int(np.frombuffer(data, np.int64, 1)[0])
        sizes, at = np.frombuffer(data, np.int64, n, 8), 8 * (n + 1)
        self.levels = []
        for size in sizes.tolist():
            self.levels.append(np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).astype(bool))
            at += (size + 7) // 8
        self._rank()
        return self


class Shard:
    """A perfect hash with an array of 32-bit fingerprints and one of document counts, and the last documents of the lines counted often enough."""

    def __init__(self, mph: bytes, prints: bytes, counts: bytes, last: bytes, min_docs: int) -> None:
        self.mph, self.min_docs = PerfectHash.load(mph), min_docs
        self.prints, self.counts, self.last = np.frombuffer(prints, np.uint32), np.frombuffer(counts, np.uint32), np.frombuffer(last, np.int64)
        self.place = np.cumsum(self.counts >= min_docs) - 1

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """In how many documents each line is (0 if it is unknown), and the last of them where they are ``min_docs`` or more."""
        i = self.mph.index(h1, h2)
        count = np.where((i >= 0) & (self.prints[i] == fingerprint(h2)), self.counts[i], 0)
        often = count >= self.min_docs
        last = np.zeros(len(h1), np.int64)
        last[often] = self.last[self.place[i[often]]]
        return count, last


def fingerprint(h2: np.ndarray) -> np.ndarray:
    return (h2.view(np.uint64) >> np.uint64(32)).astype(np.uint32)


def build_index(keys: DataFrame, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """A row per shard (shard, mph, prints, counts, last) over all distinct lines of ``keys`` (doc_id, h1, h2), each of about ``shard_keys`` lines, and the number of shards.

    Documents are told apart by doc_id (all rows without one count as one document, which is never the last);
    partial counts come before the shuffle.
    """
    some = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    counted = keys.select("h1", "h2", some.alias("doc_id")).distinct().groupBy("h1", "h2").agg(F.least(F.count("*"), F.lit((1 << 32) - 1)).alias("n_docs"), F.max("doc_id").alias("last_doc"))
    counted = save(counted, "distinct_lines")
    shards = max(1, -(-counted.count() // shard_keys))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = pdf.h1.to_numpy(np.int64), pdf.h2.to_numpy(np.int64)
        mph = PerfectHash(h1, h2)
        order = np.argsort(mph.index(h1, h2))
        n, last = pdf.n_docs.to_numpy(np.int64)[order].astype(np.uint32), pdf.last_doc.to_numpy(np.int64)[order]
        return pd.DataFrame([[int(pdf.shard.iloc[0]), mph.dump(), fingerprint(h2[order]).tobytes(), n.tobytes(), last[n >= min_docs].tobytes()]], columns=["shard", "mph", "prints", "counts", "last"])

    index = counted.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).groupBy("shard").applyInPandas(build, "shard int, mph binary, prints binary, counts binary, last binary")
    index = save(index, "line_index")
    discard(counted)
    return index, shards


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with the kept text and n_lines, n_dropped, a row per row.

    A line's key is the line stripped of ASCII white space with A-Z in lower case. Keys of at least
    ``min_chars`` code points in at least ``min_docs`` documents stay only in the largest doc_id. Null or
    empty text is one empty line, and its kept text is empty. Rows without a doc_id never are the largest
    and count as one document; repeated rows of a doc_id are one document. An empty table gives no rows. Columns
    called n_lines or n_dropped are replaced.

    The index is never held whole: each shard visits the tasks that its lines' hashes were routed to, a
    hot shard several of them, and what documents lose, by their probes of the count arrays, returns by doc_id
    (by text for rows without one). Rows are as many as distinct lines of a document, never pairs.
    """
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.drop("n_lines", "n_dropped")
    names, spread = docs.columns, F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.lit(0)).cast("long")

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, row, _, h1, h2 = hashes_of(batch.column("text").to_pylist(), min_chars)
        once = pd.DataFrame({"row": row, "h1": h1, "h2": h2}, dtype=np.int64).drop_duplicates()
        take = pa.array(once.row, pa.int64())
        return pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ("doc_id", "t")), pa.array(once.h1, pa.int64()), pa.array(once.h2, pa.int64())], ["doc_id", "t", "h1", "h2"])

    keys = save(map_batches(docs.select(F.col("doc_id").cast("long"), spread.alias("t"), "text"), emit, "doc_id long, t long, h1 long, h2 long"), "lines")
    index, shards = build_index(keys, min_docs, shard_keys)

    def visit(groups: Iterator) -> Iterator[pa.RecordBatch]:
        for _, entries, batches in groups:
            if entries is None:
                continue
            shard = Shard(*(entries.column(c)[0].as_py() for c in ("mph", "prints", "counts", "last")), min_docs)
            for batch in batches:
                count, last = shard.probe(*(np.asarray(batch.column(c)) for c in ("h1", "h2")))
                nameless = np.asarray(batch.column("doc_id").is_null())
                yield batch.filter(pa.array((count >= min_docs) & (nameless | (last != np.asarray(batch.column("doc_id").fill_null(0))))))

    rows = keys.select(F.pmod("h1", F.lit(shards)).cast("int").alias("shard"), F.lit(32).alias("size"), "doc_id", "t", "h1", "h2")
    gone = stream_by_shard(index, rows, visit, "doc_id long, t long, h1 long, h2 long", partitions)
    marks = save(gone.groupBy(F.col("doc_id").alias("_id"), F.col("t").alias("_t")).agg(F.collect_set(F.struct("h1", "h2")).alias("_gone")), "lines_to_go")
    joined = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("_id")) & (spread == F.col("_t")), "left").select(*names, "_gone")

    def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, n_lines, dropped = [], [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("_gone").to_pylist(), strict=True):
            own = (text or "").split("\n")
            if gone:
                drop = {(x["h1"], x["h2"]) for x in gone}
                kept = [x for x in own if line_hash(x.encode(), min_chars) not in drop]
            else:
                kept = own
            texts.append(text or "" if kept is own else "\n".join(kept))
            n_lines.append(len(own))
            dropped.append(len(own) - len(kept))
        columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(n_lines, pa.int64()), pa.array(dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(joined, apply, schema + ", n_lines long, n_dropped long")
