"""The corpus pipeline: documents through five stages, each stored before the next reads it.

Every stage is a function of (spark, docs, sf_dir). All but the last return
the columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from claimlens.llm import decontaminate, line_dedup, near_dedup, packing, toxicity
from claimlens.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; null texts stay."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the multi-line chunks that occurred before."""
    return line_dedup.dedup_lines(docs, keep_columns=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: that with the smallest doc_id.

    Documents without words are in no class and stay.
    """
    return near_dedup.drop_near_copies(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents left, with the sequence and place of each."""
    return packing.best_fit_pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_repeated_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaked),
    ("packing", pack),
]
# SQL cannot express the trained classifier and the packing; tests/llm holds
# the stages against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are stored and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}", "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
