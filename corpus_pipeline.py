"""The corpus pipeline: each stage works on all that the stage before it has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablesync.llm import bagminhash, decontaminate, language, mixing, sharding
from tablesync.llm.common import saved, table

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language.stage),
    ("near_duplicates", bagminhash.stage),
    ("decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
    ("sharding", sharding.stage),
]

#: Signatures, hashes of ids and Viterbi paths are not within reach of SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
