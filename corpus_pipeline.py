"""A training corpus from ``documents``: five filtering stages, each one operator of ``hearth.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
it as Parquet in the shared folder and reads it back as the next stage's input.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hearth.llm import decontam, linededup, minhash, mixing, toxicity
from hearth.llm.common import cut, load


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain trained on ``labels`` predicts to be toxic go."""
    return toxicity.keep_clean(docs, load(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Duplicate lines go, and documents that have no words left."""
    return linededup.keep_rest(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a benchmark item go."""
    return decontam.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents taken by the mix, with ``copies`` and ``taken`` words."""
    return mixing.take(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_dedup", near_dedup),
    ("decontaminate", drop_leaks),
    ("mix", mix_sources),
]

#: SQL can't express the first stage (a trained model); tests run each stage by a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
