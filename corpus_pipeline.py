"""From documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all the rows its predecessor kept. The classifiers
are fitted on a bounded sample of the table `labels` with the texts of the table `documents`, both in sf_dir.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressure.llm import minhash, packing, quality, toxicity
from pressure.llm.common import table
from pressure.sources.scratch import keep

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality.fitted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.select_good(docs, model)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = toxicity.fitted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.select_clean(docs, model)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`; each result is written and read again before the next."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = keep(stage(spark, rows, sf_dir), name)
    return STAGES[-1][1](spark, rows, sf_dir)
