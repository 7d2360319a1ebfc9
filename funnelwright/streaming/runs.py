"""Append sinks that stop and resume, and what their checkpoints tell.

A stream resumes on its checkpoint: the offset log names what each batch read, the
commit log which batches are done, and the state store holds one version a batch.
A batch that was planned but not committed runs again with the same input over the
state before it, and the sink takes its files once.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from funnelwright.session import BRIEF_SHUFFLES, settings
from funnelwright.sources.tables import delete_path, file_names

AVAILABLE_NOW = {"availableNow": True}

_STORE = "spark.sql.streaming.stateStore"
# For runs that take in much in few batches and stop: a store is closed after each of its batches, and a batch leaves
# sorted files, which the next one opens as they are instead of repeating every change.
FEW_BATCHES = {f"{_STORE}.unloadOnCommit": "true", f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "false"}


@contextmanager
def state_partitions(spark: SparkSession, number: int) -> Iterator[None]:
    """Streams that first start in here keep their state in so many partitions, for as long as their checkpoint lasts.

    Every batch commits every partition of every stateful operator, however few rows it
    holds, and each of them takes some 4 MB of local disk, so the number should follow
    the size of the state. The streams are to take few batches (``FEW_BATCHES``), and
    the shuffles of a batch go when it ends.
    """
    with settings(spark, {"spark.sql.shuffle.partitions": str(number)} | FEW_BATCHES | BRIEF_SHUFFLES):
        yield


def start_append(stream: DataFrame, root: str, trigger: dict | None = None) -> StreamingQuery:
    """Append a stream to the table ``out`` under a folder, with the checkpoint beside it."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{root}/out")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def run_available(stream: DataFrame, root: str) -> StreamingQuery:
    """Process what has arrived since the last run, then stop; returns the ended query for its progress."""
    query = start_append(stream, root, AVAILABLE_NOW)
    query.awaitTermination()
    return query


def appended(stream: DataFrame, root: str) -> DataFrame:
    """The rows that committed batches appended."""
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def _batches(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name) for name in file_names(spark, folder) if name.isdigit())


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that is done, -1 if none."""
    return max(_batches(spark, f"{checkpoint}/commits"), default=-1)


def unfinished(spark: SparkSession, checkpoint: str) -> list[int]:
    """Batches that were planned but not committed: the next run begins with them."""
    done = last_committed(spark, checkpoint)
    return [b for b in _batches(spark, f"{checkpoint}/offsets") if b > done]


def reopen_last(spark: SparkSession, checkpoint: str) -> int:
    """Take back the commit of the last batch of a stopped stream, so that the next run repeats it.

    What a crash between the sink and the commit leaves behind; also the way to
    write a batch again whose output was damaged. Returns the batch, -1 if none.
    """
    last = last_committed(spark, checkpoint)
    if last >= 0:
        delete_path(spark, f"{checkpoint}/commits/{last}")
        delete_path(spark, f"{checkpoint}/commits/.{last}.crc")
    return last


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows held in state after each batch that a query reports, over all of its operators."""
    return [sum(op["numRowsTotal"] for op in p["stateOperators"]) for p in query.recentProgress]


def dropped_late(query: StreamingQuery) -> int:
    """Rows that stateful operators dropped as late, over the batches that a query reports."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
