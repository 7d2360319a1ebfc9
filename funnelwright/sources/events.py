"""The four event streams, as batches or as Structured Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.model import event_schema

# Stream name to message topic.
TOPICS = {
    "bid_requests": "bid-requests",
    "bid_responses": "bid-responses",
    "impressions": "impressions",
    "clicks": "clicks",
}


def event_files(
    spark: SparkSession, name: str, path: str, file_format: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """A stream over a folder of event files; new files are picked up as they come."""
    reader = spark.readStream.schema(event_schema(name)).format(file_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def event_batch(spark: SparkSession, name: str, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.schema(event_schema(name)).format(file_format).load(path)


def decoded(messages: DataFrame, name: str, avro_schema: str | None = None) -> DataFrame:
    """Events out of message ``value`` bytes, as JSON, or as Avro behind a five-byte registry header.

    A value that cannot be read gives a row of nulls, which the ingest rules turn away.
    """
    if avro_schema:
        from pyspark.sql.avro.functions import from_avro

        event = from_avro(F.expr("substring(value, 6)"), avro_schema)
    else:
        event = F.from_json(F.col("value").cast("string"), event_schema(name))
    rows = messages.select(event.alias("event")).select("event.*")
    return rows.select(*event_schema(name).fieldNames())


def event_topic(spark: SparkSession, name: str, servers: str, avro_schema: str | None = None) -> DataFrame:
    """A stream over a Kafka topic from its first offset; needs the Kafka package.

    Values are JSON, or Avro if a schema is given, which also needs the Avro package.
    """
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", TOPICS[name])
        .option("startingOffsets", "earliest")
        .load()
    )
    return decoded(messages, name, avro_schema)
