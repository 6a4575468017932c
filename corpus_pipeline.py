"""From raw documents to token ids: stages that each work on all rows their predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerhub.llm import stages
from ledgerhub.llm.common import read, written_once

STAGES = [
    ("language", stages.language),
    ("quality rules", stages.quality_rules),
    ("near duplicates", stages.near_duplicates),
    ("mixing", stages.mix),
    ("byte pairs", stages.bpe_coding),
]

#: SQL has neither compression nor byte-pair coding; tests hold the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written_once(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
