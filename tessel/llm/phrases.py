"""Removal of passages that repeat across documents, by sharded Aho-Corasick automata over confirmed passages."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import discard, few, free_shuffles, map_batches, mix, pieces, row_of, save, stream_by_shard, windows, word_hashes

#: GRAM words make a print; a shard takes about SHARD_PRINTS shared prints; no automaton has more than AUTOMATON_WINDOWS keys.
WINDOW, GRAM, SHARD_PRINTS, AUTOMATON_WINDOWS, BROADCAST_ROWS = 13, 6, 8_192, 40_000, 250_000


def minimizers(h: np.ndarray, rows: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window that lies within a row: its first word's index, and the least hash of its grams."""
    n = len(h)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    g, width, have = windows(h, gram), window - gram + 1, 1
    least = g
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least, np.roll(least, -step))
        have += step
    at = _inside(rows, window)
    return at, least[at]


def _inside(rows: np.ndarray, window: int) -> np.ndarray:
    """The places from which ``window`` words lie within their row."""
    return np.flatnonzero(np.arange(rows[-1]) + window <= rows[1:][row_of(rows)])


def _shard_of(owner: np.ndarray, shards: int) -> np.ndarray:
    return ((mix(owner.view(np.uint64)) >> np.uint64(16)) % np.uint64(shards)).astype(np.int32)


def _runs(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the stretches in which the first key counts up by one and the others stay."""
    if not len(keys[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = keys[0][1:] != keys[0][:-1] + 1
    for k in keys[1:]:
        new |= k[1:] != k[:-1]
    begin = np.concatenate(([0], np.flatnonzero(new) + 1))
    return begin, np.concatenate((begin[1:], [len(keys[0])])) - 1


def _bytes(h: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    return pa.array([h[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())


def _words(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of a column of binary stretches, row after row, and where each row begins in them."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint64), np.cumsum([0, *(len(x) // 8 for x in rows)])


def remove_repeated_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_prints: int = SHARD_PRINTS) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) -> (doc_id, kept_text, n_words, n_removed), a row per row: words in a window that a smaller doc_id has too are gone.

    1. Texts that equal one with a smaller doc_id go whole, and take no further part.
    2. Every window of ``window`` words is represented by the least hash of its grams, its print, which copies of
       the window share; prints in two documents or more name the stretches where passages may repeat.
    3. Windows of these stretches are counted by hash; those in two documents are confirmed, and the first document
       of each hands in the words of the passages they make up.
    4. Passages go to shards by the first document of their print, so a document meets few shards. A shard's
       automata hold the words of every confirmed window, with its first document, and all stretches of all
       documents that have the shard's prints (no other place can hold such a window) stream through
       them. What they find is what goes; hashes decide nothing here.

    Null text has no words and its kept text is empty, as for empty text. Rows without doc_id come neither
    before nor after others, so they keep their words and cost nobody any; rows that repeat a doc_id do not
    count against each other. Other columns are left out, and an empty table gives no rows. All counts are partial
    before a shuffle, hot prints are joined under skew handling, and hot shards are split over tasks; a
    task holds one automaton of at most ``AUTOMATON_WINDOWS`` windows.
    """
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = named.withColumn("t", F.struct(F.xxhash64("text").alias("x"), F.xxhash64(F.lit(1), "text").alias("y")))
    texts = named.where("doc_id is not null").select("doc_id", "t").distinct()
    firsts = texts.groupBy("t").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("t", "first")
    copies = save(texts.join(firsts, "t").where("doc_id > first").select("doc_id", "t"), "copies")
    originals = named.where("doc_id is not null").join(few(copies, BROADCAST_ROWS), ["doc_id", "t"], "left_anti")

    def emit(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, rows = word_hashes(batch.column("text"))
        at, least = minimizers(h, rows, window, gram)
        row = row_of(rows)[at]
        new = np.concatenate(([True], (least[1:] != least[:-1]) | (row[1:] != row[:-1]))) if len(at) else np.zeros(0, bool)
        return pa.RecordBatch.from_arrays([pa.array(least[new].view(np.int64)), batch.column("doc_id").take(pa.array(row[new]))], ["fp", "doc_id"])

    prints = save(map_batches(originals.select("doc_id", "text"), emit, "fp long, doc_id long"), "prints")
    shared = save(prints.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner < last").drop("last"), "shared")
    shards = max(1, -(-shared.count() // shard_prints))
    met = save(prints.join(shared, "fp").groupBy("doc_id").agg(F.collect_set(F.struct("fp", "owner")).alias("met")), "met")
    discard(prints, shared)
    free_shuffles(spark)

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        """Stretches of windows whose print is shared, cut where the shard changes."""
        h, rows = word_hashes(batch.column("text"))
        at, least = minimizers(h, rows, window, gram)
        met, row = batch.column("met"), row_of(rows)[at]
        many = np.asarray(pa.compute.list_value_length(met))
        fp, owner = (np.asarray(met.flatten().field(x)) for x in ("fp", "owner"))
        known = _lookup(np.repeat(np.arange(len(many)), many), fp.view(np.uint64), row, least)
        hit = known >= 0
        at, row, shard = at[hit], row[hit], _shard_of(owner[known[hit]], shards)
        a, b = _runs(at, row, shard)
        words, take = _bytes(h, at[a], at[b] + window), pa.array(row[a])
        return pa.RecordBatch.from_arrays([pa.array(shard[a]), pa.compute.binary_length(words).cast(pa.int64()), *(batch.column(c).take(take) for c in ("doc_id", "t")), pa.array((at[a] - rows[:-1][row[a]]).astype(np.int32)), words], ["shard", "size", "doc_id", "t", "start", "words"])

    stretches = map_batches(originals.join(met, "doc_id").select("doc_id", "t", "text", "met"), deal, "shard int, size long, doc_id long, t struct<x:long,y:long>, start int, words binary")
    stretches = save(stretches, "stretches")
    discard(met)
    free_shuffles(spark)

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, rows = _words(batch.column("words"))
        at = _inside(rows, window)
        w = windows(h, window)[at] if len(at) else h[:0]
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), batch.column("doc_id").take(pa.array(row_of(rows)[at]))], ["w", "doc_id"])

    found = map_batches(stretches.select("doc_id", "words"), count, "w long, doc_id long")
    confirmed = found.groupBy("w").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    own = confirmed.groupBy(F.col("first").alias("doc_id")).agg(F.collect_list("w").alias("own"))

    def hand_in(batch: pa.RecordBatch) -> pa.RecordBatch:
        """The passages that a document's confirmed windows make up."""
        parts, mine = batch.column("stretches"), batch.column("own")
        many, confirmed = np.asarray(pa.compute.list_value_length(parts)), np.asarray(pa.compute.list_value_length(mine))
        doc, shard = np.repeat(np.arange(len(many)), many), np.asarray(parts.flatten().field("shard"))
        h, rows = _words(parts.flatten().field("words"))
        at = _inside(rows, window)
        part = row_of(rows)[at]
        sure = _lookup(np.repeat(np.arange(len(confirmed)), confirmed), np.asarray(mine.flatten()).view(np.uint64), doc[part], windows(h, window)[at] if len(at) else h[:0]) >= 0
        at, part = at[sure], part[sure]
        a, b = _runs(at, part)
        return pa.RecordBatch.from_arrays([pa.array(shard[part[a]]), _bytes(h, at[a], at[b] + window), batch.column("doc_id").take(pa.array(doc[part[a]]))], ["shard", "passage", "first"])

    by_doc = stretches.groupBy("doc_id").agg(F.collect_list(F.struct("shard", "words")).alias("stretches"))
    passages = save(map_batches(by_doc.join(own, "doc_id").select("doc_id", "stretches", "own"), hand_in, "shard int, passage binary, first long"), "passages")
    free_shuffles(spark)

    def run(groups: Iterator) -> Iterator[pa.RecordBatch]:
        for _, entries, batches in groups:
            if entries is None:
                continue
            parts = list(automaton_parts(entries, window))
            held = list(batches) if len(parts) > 1 else batches  # one task's share of a shard, of bounded bytes
            for part in parts:
                compiled = compile_passages(*part, window)
                for batch in held:
                    for piece in pieces(batch):
                        yield occurrences(piece, compiled, window)
                compiled = None  # before the next one is built

    places = stream_by_shard(passages, stretches, run, "doc_id long, t struct<x:long,y:long>, spans array<struct<a:int,b:int>>", partitions)
    gone = places.where(F.size("spans") > 0).groupBy("doc_id", "t").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.lit(False).alias("whole"))
    gone = save(gone.unionByName(copies.select("doc_id", "t", F.array().cast("array<struct<a:int,b:int>>").alias("spans"), F.lit(True).alias("whole"))), "places")
    discard(stretches, passages)
    free_shuffles(spark)
    some = named.where("doc_id is not null").join(gone, ["doc_id", "t"], "left").select("doc_id", "text", "spans", F.coalesce("whole", F.lit(False)).alias("whole"))
    nameless = named.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<struct<a:int,b:int>>").alias("spans"), F.lit(False).alias("whole"))

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, counts, removed = [], [], []
        for text, spans, whole in zip(batch.column("text").to_pylist(), batch.column("spans"), batch.column("whole").to_pylist(), strict=True):
            w = text.encode().split()
            counts.append(len(w))
            if whole and len(w) >= window:
                removed.append(len(w))
                texts.append("")
                continue
            gone = np.zeros(len(w) + 1, np.int64)
            if spans.is_valid:
                np.add.at(gone, np.asarray(spans.values.field("a")), 1)
                np.add.at(gone, np.asarray(spans.values.field("b")), -1)
            out = np.cumsum(gone[:-1]) > 0
            removed.append(int(out.sum()))
            texts.append(b" ".join(w if not removed[-1] else [w[i] for i in np.flatnonzero(~out)]).decode())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64())], ["doc_id", "kept_text", "n_words", "n_removed"])

    return map_batches(some.unionByName(nameless), cut, "doc_id long, kept_text string, n_words long, n_removed long")


def _lookup(rows_a: np.ndarray, a: np.ndarray, rows_b: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each (row, value) of b its index among those of a, or -1."""
    if not len(a) or not len(b):
        return np.full(len(b), -1, np.int64)
    order = np.lexsort((a, rows_a))
    rows, values = rows_a[order], a[order]
    out = np.full(len(b), -1, np.int64)
    begins = np.searchsorted(rows, np.arange(int(rows_a.max()) + 2))
    cuts = np.searchsorted(rows_b, np.arange(int(rows_a.max()) + 2))
    for r in np.unique(rows_a).tolist():
        own, ask = values[begins[r] : begins[r + 1]], b[cuts[r] : cuts[r + 1]]
        if len(own) and len(ask):
            i = np.minimum(np.searchsorted(own, ask), len(own) - 1)
            out[cuts[r] : cuts[r + 1]] = np.where(own[i] == ask, order[begins[r] + i], -1)
    return out


class Letters:
    """Words of some passages as two letters each, so that no node of an automaton has many children; all other words are one pair that no key has."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = np.unique(words)
        self.base = int(np.ceil(np.sqrt(len(self.words) + 1)))

    def spell(self, h: np.ndarray) -> str:
        i = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        i = np.where(self.words[i] == h, i, len(self.words))
        out = np.empty(2 * len(h), np.uint32)
        out[0::2], out[1::2] = 1 + i // self.base, 2 + self.base + i % self.base  # both far below the surrogates
        return out.tobytes().decode("utf-32-le")


def automaton_parts(entries: pa.Table, window: int, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The passages' words, rows, first documents and windows' places, for at most ``most`` windows each."""
    h, rows = _words(entries.column("passage"))
    first, at = np.asarray(entries.column("first")), _inside(rows, window)
    most = most or AUTOMATON_WINDOWS
    for i in range(0, len(at), most):
        yield h, rows, first, at[i : i + most]


def compile_passages(h: np.ndarray, rows: np.ndarray, first: np.ndarray, at: np.ndarray, window: int) -> tuple[ahocorasick.Automaton, Letters, list[int]]:
    """An automaton whose keys are the words of the windows at ``at``, each with the first document that holds it, by its place in a list (values have 32 bits)."""
    letters = Letters(np.concatenate([h[at], *(h[at + k] for k in range(1, window))]))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    owners, owner = np.unique(first[row_of(rows)[at]], return_inverse=True)
    a, b = _runs(at)
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        text = letters.spell(h[at[i] : at[j] + window])
        for k, o in enumerate(owner[i : j + 1].tolist()):
            automaton.add_word(text[2 * k : 2 * (k + window)], o)
    automaton.make_automaton()
    return automaton, letters, owners.tolist()


def occurrences(batch: pa.RecordBatch, compiled: tuple[ahocorasick.Automaton, Letters, list[int]], window: int) -> pa.RecordBatch:
    """The spans of words that hits of windows of a smaller document cover, by stretch."""
    automaton, letters, owners = compiled
    h, rows = _words(batch.column("words"))
    text, docs, starts = letters.spell(h), batch.column("doc_id").to_pylist(), batch.column("start").to_pylist()
    spans, ends = [], [0]
    for r, (a, b) in enumerate(zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)):
        doc, begin, reach = docs[r], 0, -1
        for end, owner in automaton.iter(text, 2 * a, 2 * b):
            if owners[owner] < doc:
                stop = end // 2 + 1 - a
                if stop - window > reach:
                    if reach >= 0:
                        spans.append((begin + starts[r], reach + starts[r]))
                    begin = stop - window
                reach = stop
        if reach >= 0:
            spans.append((begin + starts[r], reach + starts[r]))
        ends.append(len(spans))
    a, b = (np.array([s[k] for s in spans], np.int32) for k in (0, 1))
    found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(a), pa.array(b)], ["a", "b"]))
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("t"), found], ["doc_id", "t", "spans"])
