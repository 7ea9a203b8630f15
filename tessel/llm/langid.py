"""Language ID by words first, backing off to ever shorter character n-grams for words that were never seen."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessel.llm.common import map_batches, release, save, scratch_of

#: Bounds of the model: labelled documents of a language that are read for it (as expected by a hash of
#: doc_id), words kept of a language and their letters at most, the longest n-gram, n-grams kept of a length and language.
SAMPLE_DOCS, WORDS, LETTERS, LONGEST, GRAMS = 4_000, 20_000, 64, 5, 20_000
CACHE, CACHE_BYTES = 300_000, 16 << 20  # words scored by n-grams that a task remembers
FLUSH = 100_000  # n-grams that a task counts before it sends them on
NO_EVIDENCE = 0.25  # the highest score of a prediction by class shares alone
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    langs: list[str]
    words: dict[str, int]
    word_scores: np.ndarray
    grams: dict[str, int]
    gram_scores: np.ndarray
    prior: np.ndarray | None = None  # shares of the languages among the labelled rows; equal ones if not given

    def __post_init__(self) -> None:
        self._forget()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "table", "room")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state
        self._forget()

    def _forget(self) -> None:
        """Rows of scores by word: the known ones, and room for those that were scored by n-grams."""
        self.rows, self.room = dict(self.words), len(self.words) + max(1, min(CACHE, CACHE_BYTES // (4 * max(1, len(self.langs)))))
        self.table = np.zeros((self.room, len(self.langs)), np.float32)
        self.table[: len(self.words)] = self.word_scores

    def _grams(self, word: str) -> list[int]:
        """The word's longest known n-grams; parts without one fall back to shorter ones. None if no letter is known."""
        padded, get, found = f"_{word}_", self.grams.get, []
        end = len(padded)

        def cover(a: int, b: int) -> None:
            if (i := get(padded[a:b])) is not None:
                found.append(i)
            elif b - a > 1:
                cover(a, b - 1)
                if b == end or a == 0:
                    cover(a + 1, b)

        n = min(LONGEST, end)
        for a in range(end - n + 1):
            if (i := get(padded[a : a + n])) is not None:
                found.append(i)
            else:
                cover(a, a + n)
        edge = get("_")  # tells nothing of the letters
        return found if any(i != edge for i in found) else []

    def unseen(self, words: list[str]) -> np.ndarray:
        """The mean score of each word's longest known n-grams, 0 if there is none."""
        found = [self._grams(w) for w in words]
        out = np.zeros((len(words), len(self.langs)))
        some = [i for i, f in enumerate(found) if f]
        if some:
            flat = np.fromiter((x for i in some for x in found[i]), np.int64)
            many = np.array([len(found[i]) for i in some])
            out[some] = np.add.reduceat(self.gram_scores[flat], np.cumsum(many) - many, axis=0, dtype=np.float64) / many[:, None]
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        """A learned language with its share of the likelihood (0 to 1); ``und`` and 0 without letters or with an empty model.

        A sole learned language has all the likelihood. Letters that tell nothing get the most frequent language with
        a score of at most ``NO_EVIDENCE``.
        """
        counts = Counter(_WORD.findall((text or "").lower()))
        if not "".join(counts).isalpha():
            for word in [w for w in counts if not w.isalpha()]:  # holds numerals that are no digits
                n = counts.pop(word)
                for part in "".join(c if c.isalpha() else " " for c in word).split():
                    counts[part] += n
        if not counts or not self.langs:
            return "und", 0.0
        if len(self.langs) == 1:
            return self.langs[0], 1.0
        if len(self.rows) + len(counts) > self.room:
            self._forget()
        ids = np.fromiter(map(self.rows.get, counts, repeat(-1)), np.int64, len(counts))
        times, old = np.fromiter(counts.values(), np.float64, len(counts)), ids >= 0
        total = times[old] @ self.table[ids[old]]
        if not old.all():
            new = list(compress(counts, ~old))
            scores = self.unseen(new)
            total = total + times[~old] @ scores
            first, keep = len(self.rows), [i for i, w in enumerate(new) if len(w) <= LETTERS][: self.room - len(self.rows)]  # longer runs hardly come again
            self.table[first : first + len(keep)] = scores[keep]
            self.rows.update(zip((new[i] for i in keep), range(first, first + len(keep)), strict=True))
        if not total.any():
            prior = np.full(len(self.langs), 1 / len(self.langs)) if self.prior is None else self.prior
            best = int(prior.argmax())
            return self.langs[best], min(NO_EVIDENCE, float(prior[best]))
        share = np.exp(total - total.max())
        best = int(share.argmax())
        return self.langs[best], float(share[best] / share.sum())


def _log_shares(counts: dict[str, np.ndarray], totals: np.ndarray) -> tuple[dict[str, int], np.ndarray]:
    table = np.array(list(counts.values())) if counts else np.zeros((0, len(totals)))
    scores = np.log((table + 0.1) / (totals + 0.1 * max(1, len(table))))
    return {k: i for i, k in enumerate(counts)}, (scores - scores.mean(1, keepdims=True)).astype(np.float32)


def gram_counts(words: DataFrame) -> DataFrame:
    """(lang, word, n) -> (size, gram, lang, n): the n-grams of whole words, whatever their length, with the words' edges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[int, str, str]] = Counter()

        def flush() -> pa.RecordBatch:
            columns = [*zip(*counts, strict=True)] if counts else [(), (), ()]
            n = pa.array(counts.values(), pa.int64())
            out = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.string()), n], ["size", "gram", "lang", "n"])
            counts.clear()
            return out

        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                padded = f"_{word}_"
                for a in range(len(padded)):
                    for size in range(1, min(LONGEST, len(padded) - a) + 1):
                        counts[size, padded[a : a + size], lang] += n
                    if len(counts) > FLUSH:
                        yield flush()
        yield flush()

    return words.select("lang", "word", "n").mapInArrow(run, "size int, gram string, lang string, n long").groupBy("size", "gram", "lang").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, words: int = WORDS) -> Model:
    """Fits word and n-gram log frequencies on the labelled rows whose crc32(doc_id) mod 4 is not 2.

    Of each language about ``sample_docs`` documents are read, chosen by a hash of doc_id, so the model's
    cost and size are bounded whatever the table's. The words are those of at most ``LETTERS`` letters; longer runs
    teach their n-grams, all of them. Rows without lang, text or doc_id teach nothing; rows
    repeated count as often as they occur; languages are in code point order.
    """
    rows = docs.select("doc_id", "text", "lang").where("doc_id is not null and text is not null and lang is not null").where(~F.coalesce(held_out(), F.lit(False)))
    known = sorted((r.lang, r["count"]) for r in rows.groupBy("lang").count().collect())
    langs = [x for x, _ in known]
    if not langs:
        return Model([], {}, np.zeros((0, 0)), {}, np.zeros((0, 0)))
    part = F.create_map(*(F.lit(x) for lang, n in known for x in (lang, min(1.0, sample_docs / n))))
    drawn = rows.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1_000_003)) < part[F.col("lang")] * 1_000_003)
    tokens = drawn.select("lang", F.explode(F.expr(r"regexp_extract_all(lower(text), '\\p{L}+', 0)")).alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    short = F.length("word") <= LETTERS
    ranked = tokens.withColumn("rank", F.when(short, F.row_number().over(Window.partitionBy("lang", short).orderBy(F.desc("n"), "word")))).where(~short | (F.col("rank") <= words)).select("lang", "word", "n")
    with scratch_of("language model"):
        ranked = save(ranked, "words")
        counted = save(gram_counts(ranked), "grams")
    at = {x: i for i, x in enumerate(langs)}

    def by_lang(rows: list) -> dict[str, np.ndarray]:
        out: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(langs)))
        for key, lang, n in rows:
            out[key][at[lang]] += n
        return out

    by_word = by_lang(sorted((r.word, r.lang, r.n) for r in ranked.where(short).collect()))
    index, scores = _log_shares(by_word, sum(by_word.values(), np.zeros(len(langs))))
    sums = by_lang([(r["size"], r.lang, r.n) for r in counted.groupBy("size", "lang").agg(F.sum("n").alias("n")).collect()])
    grams, tables = {}, []
    for size in range(1, LONGEST + 1):
        rows = counted.where(F.col("size") == size).groupBy("gram").agg(F.sum("n").alias("all"), F.collect_list(F.struct("lang", "n")).alias("by"))
        top = rows.orderBy(F.desc("all"), "gram").limit(GRAMS * len(langs)).collect()
        own, table = _log_shares(by_lang([(r.gram, x.lang, x.n) for r in top for x in r.by]), sums[size])
        grams |= {k: i + len(grams) for k, i in own.items()}
        tables.append(table)
    release(docs.sparkSession, "language model")
    shares = np.array([n for _, n in known], np.float64)
    return Model(langs, index, scores, grams, np.concatenate(tables), shares / shares.sum())


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score per row, from text alone (columns of these names are replaced).

    Null text and text without a letter is ``und`` with score 0; letters without a known n-gram get the most
    frequent learned language with a low score; ties go to the first language in code point order; with an
    empty model all is ``und``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sent.value.predict(t) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], [*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_batches(docs, run, schema + ", lang_pred string, score double")
