"""The corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, mixing."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessel.llm import chosen_path, langid, lines, mixing, winnow
from tessel.llm.common import few, release, save, scratch_of, scratch_path

MIN_SCORE, BROADCAST_ROWS = 0.5, 250_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(f: Stage) -> Stage:
    """A stage deletes what earlier stages saved, since their results are written by then; nothing else."""

    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "stages")
        with scratch_of("stages"):
            return f(spark, docs, sf_dir)

    return run


def _own(docs: DataFrame, names: dict[str, str] | None = None) -> list:
    """The columns of docs, those that an operator's would replace from where ``_aside`` put them."""
    return [F.col(f"`{(names or {}).get(c, c)}`").alias(c) for c in docs.columns]


def _aside(docs: DataFrame, *taken: str) -> tuple[DataFrame, dict[str, str]]:
    names = {c: f"{c}__aside" for c in docs.columns if c in taken}
    return docs.withColumnsRenamed(names), names


@_stage
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language that the model tells with a score of ``MIN_SCORE`` go; null texts and texts without letters are such. Columns stay as they are."""
    rows, names = _aside(docs, "lang_pred", "score")
    judged = langid.identify(rows, langid.learn(docs))
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE)).select(*_own(docs, names))


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Frequent lines stay in one document each; a document that loses any gets a new text and n_chars, and goes if no word is left. Other columns, and documents that lose none, stay as they are, null texts as empty ones."""
    rows, names = _aside(docs, "n_lines", "n_dropped")
    kept = lines.drop_repeated_lines(rows)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.where((F.col("n_dropped") == 0) | F.col("text").rlike("[^ \\t-\\r]")).select(*_own(docs, names))


@_stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest doc_id, with all rows of that doc_id; rows without doc_id stay."""
    found = chosen_path.near_duplicates(docs)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    return docs.join(few(save(gone, "gone"), BROADCAST_ROWS), "doc_id", "left_anti").select(*_own(docs))


@_stage
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a passage of a benchmark item go, each by its own text, whatever its doc_id."""
    text = F.coalesce("text", F.lit(""))
    name = F.struct(F.xxhash64(text).alias("x"), F.xxhash64(F.lit(1), text).alias("y"))
    found = winnow.contamination(docs.select(name.alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = save(found.where("contaminated").select(F.col("doc_id").alias("_text")).distinct(), "gone")
    return docs.join(few(gone, BROADCAST_ROWS), name == F.col("_text"), "left_anti").select(*_own(docs))


@_stage
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus: every document that the mix takes words of, or that has none, with its columns and size, target and taken words.

    A trainer reads ``text`` as often as ``repetitions`` says, and then ``part_text``, the first words of a source's last
    document. A column of docs by the name of one of these keeps its values, and the new one gets ``mix_`` before its name.
    """
    mixed = mixing.mix_sources(docs.select(F.struct(*_own(docs)).alias("_row"), "doc_id", "source", "text"), carry="_row")
    mixed = mixed.withColumn("part_text", mixing.part_text(F.col("_row.text"), F.col("part")))
    new = [F.col(c).alias(f"mix_{c}" if c in docs.columns else c) for c in ("size", "source_size", "target", "taken", "repetitions", "part_text")]
    return mixed.where((F.col("taken") > 0) | (F.col("size") == 0)).select("_row.*", *new)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix)]

#: Language ID is a learned model, which SQL can't express; the tests hold run()'s rows against plain versions of the five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each one's result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, name)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
