"""The funnel kept up by deltas: a micro-batch costs its own ids, not its hour.

Counts of distinct ids over inner links only grow: a new event can add ids to an
hour, never take one away. So each hop of the chain is a stream of its own whose
keyed state holds the distinct ids and links of the last ``TTL`` of event time, finds
the partners of new rows by key, and appends each new link once, at once. The
watermark expires the state; no job has to. A counting stream turns links into
counts a batch, which reading sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from funnelwright.functions import hour_of
from funnelwright.operators.funnel import CLICK_WAIT, IMPRESSION_WAIT, RESPONSE_WAIT, stage_rates
from funnelwright.operators.joins import named
from funnelwright.sources.tables import path_exists, replace_partitions
from funnelwright.streaming.runs import run_available, start_append

#: How far behind the newest event one may still arrive, and how long ids stay in state.
TTL = "24 hours"

#: Hops after the first stage: the link before, key, id and longest wait in seconds.
HOPS = {
    "bid_responses": ("bid_requests", "request_id", "response_id", RESPONSE_WAIT),
    "impressions": ("bid_responses", "response_id", "impression_id", IMPRESSION_WAIT),
    "clicks": ("impressions", "impression_id", "click_id", CLICK_WAIT),
}
STAGE_OF = {"bid_requests": "requests", "bid_responses": "responses", "impressions": "impressions", "clicks": "clicks"}
LINK = "window_start timestamp, publisher_id int, id string, at timestamp"


def first_links(requests: DataFrame, ttl: str = TTL) -> DataFrame:
    """Distinct ids of the first stage: window_start, publisher_id, id and the event time ``at``."""
    rows = named(requests.select("request_id", "event_ts", "publisher_id"), "request_id", "event_ts")
    return (
        rows.withWatermark("event_ts", ttl)
        .dropDuplicates(["request_id", "event_ts", "publisher_id"])
        .select(
            hour_of(F.col("event_ts")).alias("window_start"),
            "publisher_id",
            F.col("request_id").alias("id"),
            F.col("event_ts").alias("at"),
        )
    )


def next_links(links: DataFrame, events: DataFrame, key: str, id_column: str, wait: int, ttl: str = TTL) -> DataFrame:
    """Distinct ids of a stage that follow a link within ``wait`` seconds, with the link's window and publisher.

    Both sides stay in state for the time to live; a link is appended once, when the
    later of its two rows arrives.
    """
    side = named(events.select(key, id_column, "event_ts"), key, id_column, "event_ts").select(
        F.col(key).alias("_key"), F.col(id_column).alias("_id"), F.col("event_ts").alias("_at")
    )
    side = side.withWatermark("_at", ttl).dropDuplicates(["_key", "_id", "_at"])
    near = (
        (F.col("id") == F.col("_key"))
        & (F.col("_at") >= F.col("at"))
        & (F.col("_at") <= F.col("at") + F.expr(f"interval {wait} seconds"))
    )
    found = links.withWatermark("at", ttl).join(side, near)
    found = found.select("window_start", "publisher_id", F.col("_id").alias("id"), F.col("_at").alias("at"))
    return found.dropDuplicates(["window_start", "publisher_id", "id", "at"])


def link_stream(spark: SparkSession, stage: str, events: DataFrame, root: str, ttl: str = TTL) -> DataFrame:
    """The links of one stage, out of its events and the links of the stage before."""
    if stage not in HOPS:
        return first_links(events, ttl)
    before, key, id_column, wait = HOPS[stage]
    links = spark.readStream.schema(LINK).parquet(f"{root}/{before}/out")
    return next_links(links, events, key, id_column, wait, ttl)


def count_batch(batch: DataFrame, batch_id: int, root: str) -> None:
    """Land one batch's counts; a retry overwrites them with the same."""
    counts = batch.groupBy("stage", "window_start", "publisher_id").agg(F.count("*").alias("n"))
    counts = counts.withColumns({"window_date": F.to_date("window_start"), "batch_id": F.lit(batch_id)})
    replace_partitions(counts, f"{root}/deltas", ["window_date", "batch_id"])


def start_counts(spark: SparkSession, root: str, trigger: dict | None = None) -> StreamingQuery:
    """Count the links of all stages as they are appended."""
    links = reduce(
        DataFrame.unionByName,
        [
            spark.readStream.schema(LINK).parquet(f"{root}/{stage}/out").withColumn("stage", F.lit(stage))
            for stage in STAGE_OF
        ],
    )
    return (
        links.writeStream.foreachBatch(lambda batch, batch_id: count_batch(batch, batch_id, root))
        .option("checkpointLocation", f"{root}/checkpoint-counts")
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )


def start_funnel(
    spark: SparkSession, stages: dict[str, DataFrame], root: str, ttl: str = TTL, trigger: dict | None = None
) -> list[StreamingQuery]:
    """Start a stream for each stage's links and one that counts them; ``stages`` are stage streams by name."""
    _prepare(spark, root)
    started = [
        start_append(link_stream(spark, stage, stages[name], root, ttl), f"{root}/{stage}", trigger)
        for stage, name in STAGE_OF.items()
    ]
    return [*started, start_counts(spark, root, trigger)]


def run_funnel(spark: SparkSession, stages: dict[str, DataFrame], root: str, ttl: str = TTL) -> list[StreamingQuery]:
    """Process what has arrived, stage after stage, then stop; returns the ended queries."""
    _prepare(spark, root)
    ended = [
        run_available(link_stream(spark, stage, stages[name], root, ttl), f"{root}/{stage}")
        for stage, name in STAGE_OF.items()
    ]
    counting = start_counts(spark, root, {"availableNow": True})
    counting.awaitTermination()
    return [*ended, counting]


def _prepare(spark: SparkSession, root: str) -> None:
    """A stream over a folder needs the folder; an empty one has no rows."""
    for stage in STAGE_OF:
        if not path_exists(spark, f"{root}/{stage}/out"):
            spark.createDataFrame([], LINK).write.parquet(f"{root}/{stage}/out")


def funnel_counts(spark: SparkSession, root: str, first_day=None, last_day=None) -> DataFrame:
    """The funnel per hour and publisher as counted so far; days prune what is read."""
    deltas = spark.read.parquet(f"{root}/deltas")
    if first_day is not None:
        deltas = deltas.filter(F.col("window_date") >= F.to_date(F.lit(first_day)))
    if last_day is not None:
        deltas = deltas.filter(F.col("window_date") <= F.to_date(F.lit(last_day)))
    of = lambda stage: F.coalesce(F.sum(F.when(F.col("stage") == stage, F.col("n"))), F.lit(0))
    return stage_rates(
        deltas.groupBy("window_start", "publisher_id").agg(*[of(stage).alias(stage) for stage in STAGE_OF])
    )
