"""The corpus pipeline: from documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from funnelwright.llm import linededup, neardup, packing, pseudonyms, toxicity
from funnelwright.llm.common import documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Each takes what the stage before it kept. The last returns where each piece of each document goes.
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity.toxicity_stage),
    ("line_dedup", linededup.line_stage),
    ("near_dedup", neardup.near_duplicate_stage),
    ("pseudonyms", pseudonyms.pseudonym_stage),
    ("packing", packing.packing_stage),
]

#: SQL expresses neither the fitted chain nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each written as Parquet and read by the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
