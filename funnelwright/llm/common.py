"""What several corpus operators share: reading tables, storing steps, packed words."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.session import work_dir
from funnelwright.sources.tables import delete_path

WORDS = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


#: Bytes of a batch that a Python worker gets at once, so that long texts do not add up in memory.
BATCH_BYTES = 4 * 1024 * 1024


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, and bound their batches.

    The path is enough wherever executors see the same one, as with a local
    master; elsewhere the package is installed on the executors or shipped with
    ``--py-files``.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    here = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if here not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), here])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step into the folder that all executors share, and read it back.

    Cuts the lineage: a lost executor costs the tasks under way, not the steps
    before them.
    """
    spark = df.sparkSession
    path = f"{work_dir(spark)}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(step: DataFrame) -> None:
    """Delete a stored step that nothing reads any more."""
    delete_path(step.sparkSession, step.stored_path)


def quoted(name: str) -> str:
    """A column's name as an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def for_workers(df: DataFrame, kept: list[str]) -> DataFrame:
    """These columns under names that Spark can hand to workers: one with a dot or a backtick is numbered."""
    plain = [f"_column_{i}" if "." in c or "`" in c else c for i, c in enumerate(kept)]
    return df.select(*[F.col(quoted(c)).alias(p) for c, p in zip(kept, plain, strict=True)])


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]
