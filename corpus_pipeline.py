"""A small training-data pipeline over ``documents``: five stages, each written
as Parquet and read again as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from netcap.llm import langid, line_dedup, mixing, ngram_join, packing
from netcap.llm.common import for_workers, fresh, read_table, written


def _with_length(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, after the text has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if (
        "n_chars" in docs.columns) else docs


@for_workers
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (null or no letters)."""
    names = docs.columns
    lang, score = fresh(names, "_lang"), fresh(names, "_score")
    judged = langid.predict(docs, langid.train(langid.training_rows(docs)), lang, score)
    return judged.filter(F.col(lang) != langid.UNDETERMINED).select(
        *[F.col(f"`{c}`") for c in names])


@for_workers
def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes repeated runs of lines; documents of which no word is left by that go."""
    names = docs.columns
    lines, gone = fresh(names, "_lines"), fresh(names, "_deleted")
    left = line_dedup.dedup_lines(docs, lines=lines, deleted=gone)
    left = left.filter((F.col(gone) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _with_length(left.select(*[F.col(f"`{c}`") for c in names]))


@for_workers
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, the smallest id's."""
    return ngram_join.one_of_each(docs)


@for_workers
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents by their source's rate and shuffles them all."""
    return mixing.mix_documents(docs)


@for_workers
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("ngram_join", near_duplicates),
    ("source_mix", source_mix),
    ("packing", pack_sequences),
]

# Stages 1, 3 and 5 can't be put in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
