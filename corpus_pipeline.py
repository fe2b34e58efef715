"""A corpus pipeline of five stages over documents, each written and read again by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept. All but the last return the
columns of documents; the last returns how many copies of each document the mix takes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstream.llm import decontamination, linededup, mixing, simhash, toxicity
from rillstream.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language models reject go."""
    return toxicity.keep_ordinary(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of another document before go; documents stay, also without a line, and n_chars follows the text."""
    kept = linededup.drop_repeated(docs).select(*docs.columns)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by a five-word similarity of 0.8 the one with the smallest doc_id stays.

    SimHash fingerprints give the first candidates, MinHash bands those that differ in more bits; all are confirmed on whole sets.
    """
    return simhash.keep_one(docs, words=5, similarity=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go; items of fewer than five words remove none."""
    return decontamination.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), least_words=5)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) of a mix of what is left."""
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated), ("mixing", mix_sources)]

#: Scores, fingerprints and drawn copies are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
