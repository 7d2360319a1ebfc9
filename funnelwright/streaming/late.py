"""Late rows as a side output.

A stateful operator drops rows behind the watermark without a trace. Here a batch
is split by the same watermark before any state sees it: the newest event time of
the batches before, less the lateness allowed. The late rows are kept, and what
reads the rest never drops a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from funnelwright.sources.tables import create_table, delete_path, path_exists, replace_partitions

_MARKS = "_event_time"


def _mark(spark: SparkSession, root: str, batch_id: int) -> int | None:
    """Newest event time in microseconds of all batches through one; None before any."""
    path = f"{root}/{_MARKS}/{batch_id}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    return spark.read.parquet(path).first()[0]


def watermark(spark: SparkSession, root: str, batch_id: int, lateness_s: int) -> int | None:
    """The watermark in microseconds under which a batch runs, cut to milliseconds as Spark keeps it; None if there is none yet."""
    newest = _mark(spark, root, batch_id - 1)
    return None if newest is None else (newest // 1000 - lateness_s * 1000) * 1000


def advance(batch: DataFrame, batch_id: int, root: str, ts: str) -> None:
    """Note the newest event time through this batch; again the same on a retry.

    One row a batch. The mark before stays for a retry; older ones go.
    """
    spark = batch.sparkSession
    known = [_mark(spark, root, batch_id - 1), batch.agg(F.max(F.unix_micros(ts))).first()[0]]
    newest = max((k for k in known if k is not None), default=None)
    row = spark.createDataFrame([(newest,)], "newest bigint")
    create_table(row, f"{root}/{_MARKS}/{batch_id}")
    if path_exists(spark, f"{root}/{_MARKS}/{batch_id - 2}"):
        delete_path(spark, f"{root}/{_MARKS}/{batch_id - 2}")


def is_late(ts: str, behind: int | None):
    """Rows at or behind the watermark. Rows without a time are not late."""
    return F.lit(False) if behind is None else F.coalesce(F.unix_micros(ts) <= behind, F.lit(False))


def split_batch(batch: DataFrame, batch_id: int, root: str, ts: str, lateness_s: int) -> None:
    """Write the rows of a micro-batch to ``on_time`` or, with the ``watermark`` they missed, to ``late``.

    Partitions of its own batch, which a retry overwrites with the same rows.
    """
    spark = batch.sparkSession
    behind = watermark(spark, root, batch_id, lateness_s)
    late = is_late(ts, behind)
    rows = batch.withColumn("batch_id", F.lit(batch_id)).persist()
    try:
        replace_partitions(rows.filter(~late), f"{root}/on_time", ["batch_id"])
        missed = rows.filter(late).withColumn("watermark", F.timestamp_micros(F.lit(behind).cast("long")))
        replace_partitions(missed, f"{root}/late", ["batch_id"])
        advance(rows, batch_id, root, ts)
    finally:
        rows.unpersist()


def late_rows(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """What was split off so far, none at first; ``schema`` is that of the stream."""
    missed = StructType([*schema.fields, StructField("watermark", TimestampType()), StructField("batch_id", LongType())])
    return spark.read.schema(missed).parquet(f"{root}/late")


def start_split(
    stream: DataFrame, root: str, checkpoint: str, ts: str, lateness_s: int, trigger: dict | None = None
) -> StreamingQuery:
    """Split a stream into the tables ``on_time`` and ``late`` under a folder."""
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: split_batch(batch, batch_id, root, ts, lateness_s))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )
