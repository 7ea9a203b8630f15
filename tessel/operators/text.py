"""Token windows, corpus statistics, tokenizer comparison and full-text index, all as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

WHITE, PUNCT = "white", "punct"


def tokens(text: Column, tokenizer: str = WHITE) -> Column:
    """``white`` splits at white space; ``punct`` gives ASCII alphanumeric runs and single other characters. Null text has none."""
    text = F.coalesce(text, F.lit(""))
    if tokenizer == WHITE:
        return F.array_remove(F.split(text, r"\s+"), "")
    return F.regexp_extract_all(text, F.lit(r"[A-Za-z0-9]+|[^\sA-Za-z0-9]"), F.lit(0))


def token_windows(docs: DataFrame, size: int, overlap: float = 0.1, drop_tail: bool = True, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """keep columns + (chunk_index, chunk_text, chunk_tokens, chunk_token_count): windows of ``size`` tokens that share int(size * overlap).

    A text of up to ``size`` tokens is one chunk with its own text. A last window shorter than the overlap
    goes if ``drop_tail``; of exactly that length it stays. No shuffle: scan, generate, project.
    """
    o = int(size * overlap)
    s = size - o
    n = F.size("_t")
    last = F.floor((n - F.lit(max(o, 1) if drop_tail else 1)) / s).cast("int")
    starts = F.when(n <= size, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), last))
    rows = docs.select(*keep, F.col(text).alias("_x"), tokens(F.col(text)).alias("_t")).select(*keep, "_x", "_t", F.explode(starts).alias("chunk_index"))
    part = F.slice("_t", F.col("chunk_index") * s + 1, size)
    rows = rows.withColumn("chunk_tokens", part)
    words = F.when(n <= size, F.col("_x")).otherwise(F.array_join("chunk_tokens", " "))
    return rows.select(*keep, F.col("chunk_index").cast("long").alias("chunk_index"), words.alias("chunk_text"), "chunk_tokens", F.size("chunk_tokens").cast("long").alias("chunk_token_count"))


class CodePoints:
    """A tokenizer whose ids are code points, between two special ones; the shape that ``token_windows_by`` asks for."""

    begin, end = 101, 102

    def encode(self, texts: list[str], special_tokens: bool) -> list[list[int]]:
        ids = [list(map(ord, t)) for t in texts]
        return [[self.begin, *x, self.end] for x in ids] if special_tokens else ids

    def decode(self, ids: list[int]) -> str:
        return "".join(map(chr, ids))


class TokenizerFile:
    """A tokenizer of the ``tokenizers`` library by the path of its file, which all executors must see."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def encode(self, texts: list[str], special_tokens: bool) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch(texts, add_special_tokens=special_tokens)]

    def decode(self, ids: list[int]) -> str:
        return self.tokenizer.decode(ids, skip_special_tokens=False)


def token_windows_by(docs: DataFrame, size: int, make: Callable[[], object], overlap: float = 0.1, drop_tail: bool = True, keep: tuple[str, ...] = ("doc_id",), text: str = "text", special_tokens: bool = True) -> DataFrame:
    """``token_windows`` of a tokenizer that ``make`` builds once per task: chunk_tokens are its ids, chunk_text what it decodes them to (a text of up to ``size`` tokens stays as it is).

    With ``special_tokens`` those that the tokenizer puts around a text are counted and cut like all others.
    """
    o = int(size * overlap)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = make()
        for pdf in batches:
            rows = []
            for i, (t, ids) in enumerate(zip(pdf[text], tokenizer.encode(pdf[text].fillna("").tolist(), special_tokens), strict=True)):
                if len(ids) <= size:
                    rows.append((i, 0, t, ids))
                    continue
                for k, at in enumerate(range(0, len(ids), size - o)):
                    part = ids[at : at + size]
                    if drop_tail and len(part) < o:
                        break
                    rows.append((i, k, tokenizer.decode(part), part))
            at, index, words, ids = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pdf[list(keep)].iloc[list(at)].reset_index(drop=True).assign(chunk_index=index, chunk_text=words, chunk_tokens=ids, chunk_token_count=[len(x) for x in ids])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*dict.fromkeys((*keep, text))).mapInPandas(run, f"{fields}, chunk_index long, chunk_text string, chunk_tokens array<int>, chunk_token_count long")


@udtf(returnType="chunk_index: bigint, chunk_text: string, chunk_token_count: bigint")
class ChunkRow:
    """The same windows as a Python table function, for tokenizers that only Python has."""

    def eval(self, text: str, size: int, o: int):  # noqa: ANN201
        t = (text or "").split()
        if len(t) <= size:
            yield 0, text, len(t)
            return
        for k in range((len(t) - o) // (size - o) + 1):
            w = t[k * (size - o) : k * (size - o) + size]
            yield k, " ".join(w), len(w)


def summary(chunks: DataFrame, by: str) -> DataFrame:
    """Rows, tokens and short chunks per ``by`` and in total (null), in one pass."""
    n = F.col("chunk_token_count")
    return chunks.rollup(by).agg(F.count("*").alias("num_rows"), F.sum(n).alias("tokens"), *(F.count_if(n < k).alias(f"less{k}") for k in (2, 10, 50)))


def compare_tokenizers(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    a, b = tokens(F.col("text"), WHITE), tokens(F.col("text"), PUNCT)
    rows = docs.select(key, a.alias("a"), b.alias("b"))
    return rows.select(key, *(F.size(x).cast("long").alias(f"{n}_count") for n, x in ((WHITE, "a"), (PUNCT, "b"))), *(F.size(F.array_distinct(x)).cast("long").alias(f"{n}_unique") for n, x in ((WHITE, "a"), (PUNCT, "b"))), F.col("a").eqNullSafe(F.col("b")).alias("identical"))


def postings(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """(term, key, tf): an inverted index, with partial counts before its one shuffle."""
    return docs.select(key, F.explode(tokens(F.lower(text))).alias("term")).groupBy("term", key).agg(F.count("*").alias("tf"))


def bm25(docs: DataFrame, key: str, text: str, terms: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(key, score) of documents with any of ``terms``; only their postings are shuffled."""
    rows = docs.select(key, tokens(F.lower(F.col(text))).alias("t")).select(key, F.size("t").alias("len"), F.filter("t", lambda x: x.isin(terms)).alias("hits"))
    stats = rows.agg(F.count("*").alias("n"), F.avg("len").alias("avg_len"))
    tf = rows.where(F.size("hits") > 0).select(key, "len", F.explode("hits").alias("term")).groupBy(key, "len", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.col("avg_len")))
    return tf.join(F.broadcast(df), "term").crossJoin(F.broadcast(stats)).groupBy(key).agg(F.round(F.sum(score), 6).alias("score"))  # both sides: one row a query term, one row
