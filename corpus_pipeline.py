"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes what its predecessor kept, is written as Parquet and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termtide.llm import stages
from termtide.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language identification", stages.keep_languages),
    ("near copies", stages.drop_near_copies),
    ("personal data", stages.hide_private),
    ("mix sources to target weights", stages.mix_sources),
    ("best-fit packing", stages.pack),
]

# Mixing, alignment and packing have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
