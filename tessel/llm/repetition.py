"""Repetition rules from a suffix array over the words of each text."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessel.llm.common import map_batches, row_of, word_hashes

MIN_REPEAT, MAX_COVERED, MAX_LONGEST = 5, 0.5, 200
BASE_WINDOW, BASE_MIN_WORDS, BASE_PERCENT = 8, 20, 30
_SPACES, _SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
_SOLID = re.compile(r"[^ \t\n\x0b\x0c\r]")


def dense(x: np.ndarray) -> np.ndarray:
    """Ranks from 0 without holes."""
    order = np.argsort(x, kind="stable")
    sorted_x = x[order]
    out = np.empty(len(x), np.int64)
    out[order] = np.cumsum(np.concatenate(([0], sorted_x[1:] != sorted_x[:-1])))
    return out


def first_places(rank: np.ndarray) -> np.ndarray:
    """Dense ranks as the number of smaller entries, which leaves room to split groups."""
    size = np.bincount(rank)
    return (np.cumsum(size) - size)[rank]


def suffix_array(symbols: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, int]:
    """Suffix array by prefix doubling, and a length that no two suffixes of a row share.

    A suffix ends with its row, and sorts before its extensions. Each doubling sorts only suffixes that
    still tie, so a text without long repeats costs a few short rounds; only the last ranks are held.
    """
    n = len(symbols)
    rank = first_places(dense(dense(symbols) + row.astype(np.int64) * n))
    last = np.searchsorted(row, row, "right")
    h = 1
    tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    while len(tied):
        beyond = tied + h
        follow = np.where(beyond < last[tied], rank[np.minimum(beyond, n - 1)] + 1, 0)
        order = np.argsort(rank[tied] * np.int64(n + 1) + follow, kind="stable")
        a, b = rank[tied][order], follow[order]
        new_group = np.concatenate(([True], a[1:] != a[:-1]))
        new_key = new_group | np.concatenate(([True], b[1:] != b[:-1]))
        at = np.arange(len(a))
        start = np.maximum.accumulate(np.where(new_group, at, 0))
        key = np.maximum.accumulate(np.where(new_key, at, 0))
        rank[tied[order]] = a + (key - start)
        h *= 2
        tied = tied[np.bincount(rank, minlength=n)[rank[tied]] > 1]
    return np.argsort(rank, kind="stable"), h


class Stretches:
    """Equality of stretches of symbols by sums of symbols times powers, modulo two primes: 32 bytes a symbol, whatever the length."""

    PRIMES, BASES = (2147483647, 2147483629), (1103515245, 1664525009)

    def __init__(self, symbols: np.ndarray) -> None:
        self.sums, self.powers = [], []
        for prime, base in zip(map(np.uint64, self.PRIMES), self.BASES, strict=True):
            powers, step = np.ones(1, np.uint64), base
            while len(powers) <= len(symbols):
                powers = np.concatenate((powers, powers * np.uint64(step) % prime))
                step = step * step % int(prime)
            powers = powers[: len(symbols) + 1]
            terms = (symbols.view(np.uint64) % prime) * powers[:-1] % prime
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms) % prime)))
            self.powers.append(powers)

    def same(self, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
        """Whether the ``length`` symbols from a equal those from b, which lie within the symbols."""
        out, first, gap = np.ones(len(a), bool), np.minimum(a, b), np.abs(a - b)
        second = first + gap
        for prime, sums, powers in zip(map(np.uint64, self.PRIMES), self.sums, self.powers, strict=True):
            x = (sums[first + length] + prime - sums[first]) % prime * powers[gap] % prime
            out &= x == (sums[second + length] + prime - sums[second]) % prime
        return out


def longest_repeats(symbols: np.ndarray, row: np.ndarray) -> np.ndarray:
    """For each position the length of the longest substring from there that occurs elsewhere in its row.

    From the common prefixes (LCP) of neighbours in the suffix array: the larger of a suffix's two is the
    value of the deepest LCP interval that holds it, and that interval's string is a maximal repeat.
    """
    n = len(symbols)
    if n < 2:
        return np.zeros(n, np.int64)
    array, most = suffix_array(symbols, row)
    last = np.searchsorted(row, row, "right")
    lcp = np.zeros(n - 1, np.int64)
    live = np.flatnonzero((symbols[array[:-1]] == symbols[array[1:]]) & (row[array[:-1]] == row[array[1:]]))
    i, j = array[live], array[live + 1]
    stretches, step, depth = Stretches(symbols), most, np.zeros(len(live), np.int64)
    while step:
        a, b = i + depth, j + depth
        inside = np.flatnonzero((a + step <= last[i]) & (b + step <= last[j]))
        depth[inside[stretches.same(a[inside], b[inside], step)]] += step
        step //= 2
    lcp[live] = depth
    out = np.zeros(n, np.int64)
    np.maximum.at(out, array[:-1], lcp)
    np.maximum.at(out, array[1:], lcp)
    return out


def covered(length: np.ndarray, row: np.ndarray, at_least: int) -> np.ndarray:
    """Whether each position lies in the union of [i, i + length) over lengths of ``at_least``."""
    n = len(length)
    reach = np.where(length >= at_least, np.arange(n) + length, 0)
    return np.maximum.accumulate(reach) > np.arange(n) if n else np.zeros(0, bool)


def repetition(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """``docs`` (doc_id, text) -> (doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, covered_words, longest_repeat, kept).

    Maximal repeats of at least ``min_repeat`` words are united; a text is kept if it passes the base rule,
    they cover at most ``max_covered`` of its words, and none has over ``max_longest``. Null or empty text
    has no words and fails the base rule. Every row is judged by itself, repeated ones alike; doc_id is only
    carried. Words are compared by 64-bit hashes, within a text.
    """

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, rows = word_hashes(batch.column("text"))
        row, n = row_of(rows), np.diff(rows)
        length = longest_repeats(h.view(np.int64), row)
        total = lambda mask: np.bincount(row[mask], minlength=len(n)).astype(np.int64)
        repeat = total(covered(np.where(length >= BASE_WINDOW, length, 0), row, BASE_WINDOW))
        cover = total(covered(length, row, min_repeat))
        longest = np.zeros(len(n), np.int64)
        np.maximum.at(longest, row, length)
        chars, symbols, dups = [], [], []
        for text in batch.column("text").to_pylist():
            t = text or ""
            chars.append(len(t) - sum(map(t.count, _SPACES)))
            symbols.append(sum(map(t.count, _SYMBOLS)))
            lines = [x for x in t.split("\n") if _SOLID.search(x)]
            dups.append(len(lines) - len(set(lines)))
        failed = (n < BASE_MIN_WORDS) | (100 * repeat > BASE_PERCENT * n)
        kept = ~failed & (cover <= max_covered * n) & (longest <= max_longest)
        columns = {"doc_id": batch.column("doc_id"), "n_words": n.astype(np.int64), "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dups, "n_repeat_words": repeat, "base_failed": failed, "covered_words": cover, "longest_repeat": longest, "kept": kept}
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) if len(x) else pa.array(x, pa.int64()) for x in columns.values()], list(columns))

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), judge, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, covered_words long, longest_repeat long, kept boolean")
