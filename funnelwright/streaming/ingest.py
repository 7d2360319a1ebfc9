"""Streaming ingestion: one scan of each stream feeds all of its fact tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from funnelwright.model import FACT_PARTITIONS, conform
from funnelwright.operators.ingest import FACT_BUILDERS
from funnelwright.sources.tables import compacted_through, replace_partitions, with_event_date


def write_batch(batch: DataFrame, batch_id: int, stream: str, root: str) -> None:
    """Write a micro-batch to every fact table of its stream.

    Rows go to partitions of their own batch, which a retry overwrites with
    the same rows: no loss and no doubles after a failure.
    """
    tables = {table: build for table, (topic, build) in FACT_BUILDERS.items() if topic == stream}
    if len(tables) > 1:
        batch.persist()
    try:
        for table, build in tables.items():
            if batch_id <= compacted_through(batch.sparkSession, root, table):
                continue  # a retry of a batch whose rows have been merged already
            second = FACT_PARTITIONS[table]
            rows = with_event_date(conform(build(batch), table)).withColumn("batch_id", F.lit(batch_id))
            replace_partitions(
                rows, f"{root}/{table}", ["event_date", *([second] if second else []), "batch_id"]
            )
    finally:
        batch.unpersist()


def start_ingest(
    streams: Mapping[str, DataFrame], root: str, checkpoints: str, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Start one query per event stream, each with its own checkpoint."""

    def sink(stream: str):
        return lambda batch, batch_id: write_batch(batch, batch_id, stream, root)

    return [
        events.writeStream.foreachBatch(sink(stream))
        .option("checkpointLocation", f"{checkpoints}/ingest_{stream}")
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
        for stream, events in streams.items()
    ]
