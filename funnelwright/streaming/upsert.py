"""Hourly and per-minute aggregates that stay exact under late and repeated events.

Distinct counts cannot be kept in streaming state. So each micro-batch lands
its rows, finds the hours they can change, and recomputes those hours with
the batch operators over the landed rows. Overwriting an hour is an upsert of
all of its keys, and doing it twice changes nothing. All copies of an event
must carry the same event time, as a resent event does. Landed rows live for
``TTL_HOURS`` of event time: later events go to ``expired``, and each batch removes the
hours that none can reach any more.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from funnelwright.operators import funnel, landscape, quality, serving, stages
from funnelwright.sources.tables import delete_path, path_exists, replace_partitions, subfolders
from funnelwright.streaming import late

# A row can change windows this many seconds before or after its own time: a
# click reaches back to its request, a request forward to its impressions.
BACK = funnel.RESPONSE_WAIT + funnel.IMPRESSION_WAIT + funnel.CLICK_WAIT
AHEAD = max(serving.REQUEST_LEAD, landscape.AFTER_REQUEST)

Frames = Mapping[str, DataFrame]

_HOUR = "yyyy-MM-dd-HH"
#: How far behind the newest event one is still taken, and so how long landed rows live.
TTL_HOURS = 24


def _funnel(f: Frames) -> DataFrame:
    return funnel.hourly_funnel(f["requests"], f["responses"], f["impressions"], f["clicks"])


AGGREGATES: dict[str, Callable[[Frames], DataFrame]] = {
    "hourly_impressions_by_geo": lambda f: serving.hourly_geo(f["impressions"], f["requests"]),
    "dq_event_quality_hourly": lambda f: quality.hourly_quality(
        f["requests"], f["responses"], f["impressions"], f["clicks"]
    ),
    "bid_landscape_hourly": lambda f: landscape.hourly_landscape(f["bids"], f["requests"]),
    "realtime_serving_metrics_1m": lambda f: serving.serving_per_minute(f["impressions"], f["clicks"]),
    "hourly_funnel_by_publisher": _funnel,
    "funnel_leakage_hourly": lambda f: funnel.leakage(_funnel(f), "window_start"),
}


#: The event streams that each aggregate reads.
READS: dict[str, tuple[str, ...]] = {
    "hourly_impressions_by_geo": ("bid_requests", "impressions"),
    "dq_event_quality_hourly": ("bid_requests", "bid_responses", "impressions", "clicks"),
    "bid_landscape_hourly": ("bid_requests", "bid_responses"),
    "realtime_serving_metrics_1m": ("impressions", "clicks"),
    "hourly_funnel_by_publisher": ("bid_requests", "bid_responses", "impressions", "clicks"),
    "funnel_leakage_hourly": ("bid_requests", "bid_responses", "impressions", "clicks"),
}

# Columns of landed rows, whichever streams are there.
_COLUMNS = """request_id string, response_id string, impression_id string, click_id string, publisher_id int,
    country string, is_invalid boolean, bids array<struct<bid_id: string, bid_price: double>>, bidder_id int,
    win_price double, event_ts timestamp"""


def envelope(events: Mapping[str, DataFrame]) -> DataFrame:
    """The event streams as one stream of narrow rows, so one query sees them all.

    A stream that is left out has no rows.
    """
    bids = F.transform(
        stages.seat_bids(), lambda b: F.struct(b["id"].alias("bid_id"), b["price"].alias("bid_price"))
    )

    cuts = {
        "requests": ("bid_requests", stages.request_stage),
        "responses": ("bid_responses", lambda responses: stages.response_stage(responses, bids.alias("bids"))),
        "impressions": ("impressions", stages.impression_stage),
        "clicks": ("clicks", stages.click_stage),
    }
    frames = {stage: cut(events[name]) for stage, (name, cut) in cuts.items() if name in events}
    known = {c for df in frames.values() for c in df.columns}
    missing = [f for f in StructType.fromDDL(_COLUMNS) if f.name not in known]
    rows = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.withColumn("stage", F.lit(stage)) for stage, df in frames.items()],
    ).filter(F.col("event_ts").isNotNull())
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def _landed(spark: SparkSession, root: str, hours: list[str], schema: StructType) -> Frames:
    """Landed rows of these hours and their neighbours; other partitions are not read."""
    near = {
        (datetime.strptime(h, "%Y-%m-%d-%H") + timedelta(hours=step)).strftime("%Y-%m-%d-%H")
        for h in hours
        for step in (-1, 0, 1)
    }
    base = f"{root}/landed"
    names = ("requests", "responses", "impressions", "clicks")
    paths = [f"{base}/stage={s}/event_hour={h}" for s in names for h in sorted(near)]
    # Only these folders are listed, not all that ever landed.
    paths = [path for path in paths if path_exists(spark, path)]
    rows = spark.read.schema(schema).option("basePath", base).parquet(*paths)

    def stage(name: str, *columns: str) -> DataFrame:
        return rows.filter(F.col("stage") == name).select(*columns)

    return {
        "requests": stage("requests", "request_id", "event_ts", "publisher_id", "country", "is_invalid"),
        "responses": stage("responses", "response_id", "request_id", "event_ts"),
        "bids": stage("responses", "request_id", "event_ts", F.explode("bids").alias("bid")).select(
            "bid.bid_id", "request_id", "bid.bid_price", "event_ts"
        ),
        "impressions": stage(
            "impressions", "impression_id", "request_id", "response_id", "bidder_id", "win_price", "event_ts"
        ),
        "clicks": stage("clicks", "click_id", "impression_id", "event_ts"),
    }


def upsert_batch(
    batch: DataFrame, batch_id: int, root: str, tables: list[str], ttl_hours: int | None = TTL_HOURS
) -> None:
    """Land a micro-batch and restate the hours it can change.

    Rows further behind the newest event of earlier batches than the time to live
    are landed apart, since the rows they would be counted with are gone. None
    keeps all.
    """
    spark = batch.sparkSession
    hour = F.date_format("event_ts", _HOUR)
    batch = batch.withColumn("event_hour", hour).withColumn("batch_id", F.lit(batch_id)).persist()
    try:
        behind = late.watermark(spark, root, batch_id, ttl_hours * 3600) if ttl_hours else None
        if behind is not None:
            replace_partitions(batch.filter(late.is_late("event_ts", behind)), f"{root}/expired", ["stage", "batch_id"])
        _restate(batch.filter(~late.is_late("event_ts", behind)), root, tables)
        if ttl_hours:
            late.advance(batch, batch_id, root, "event_ts")
    finally:
        batch.unpersist()
    if behind is not None:
        # Rows after the watermark restate hours from BACK seconds before it on, and read one hour more.
        reached = datetime(1970, 1, 1) + timedelta(microseconds=behind) - timedelta(seconds=BACK)
        expire_landed(spark, root, reached - timedelta(hours=1))


def _restate(landed: DataFrame, root: str, tables: list[str]) -> None:
    spark = landed.sparkSession
    replace_partitions(landed, f"{root}/landed", ["stage", "event_hour", "batch_id"])
    reach = F.array(
        *[F.date_format(F.timestamp_micros(F.unix_micros("event_ts") + s * 1_000_000), _HOUR) for s in (-BACK, 0, AHEAD)]
    )
    # A list of hours: a few for live data, a few thousand for a backfill of months.
    hours = sorted(r[0] for r in landed.select(F.explode(reach)).distinct().collect())
    if not hours:
        return
    frames = _landed(spark, root, hours, landed.schema)
    for table in [t for t in AGGREGATES if t in tables]:
        if table == "funnel_leakage_hourly" and "hourly_funnel_by_publisher" in tables:
            # The funnel was written just before; leakage is arithmetic on it.
            counts = spark.read.parquet(f"{root}/hourly_funnel_by_publisher")
            rows = funnel.leakage(counts.filter(F.col("window_hour").isin(hours)), "window_start")
        else:
            rows = AGGREGATES[table](frames)
        fresh = rows.withColumn("window_hour", F.date_format("window_start", _HOUR))
        fresh = fresh.filter(F.col("window_hour").isin(hours))
        replace_partitions(fresh, f"{root}/{table}", ["window_hour"])


def expire_landed(spark: SparkSession, root: str, before: datetime) -> int:
    """Remove landed rows of hours before that of a time; returns how many folders went.

    Events that arrive for a removed hour afterwards would restate it from
    themselves alone, so ``before`` must lie behind anything that is still
    taken, by the reach of the joins.
    """
    base, limit, gone = f"{root}/landed", before.strftime("%Y-%m-%d-%H"), 0
    if not path_exists(spark, base):
        return 0
    for stage in [s for s in subfolders(spark, base) if s.startswith("stage=")]:
        for hour in subfolders(spark, f"{base}/{stage}"):
            if hour.startswith("event_hour=") and hour.split("=", 1)[1] < limit:
                delete_path(spark, f"{base}/{stage}/{hour}")
                gone += 1
    return gone


def start_upserts(
    events: Mapping[str, DataFrame],
    root: str,
    checkpoint: str,
    tables: list[str] | None = None,
    trigger: dict | None = None,
    ttl_hours: int | None = TTL_HOURS,
) -> StreamingQuery:
    """Start the aggregation query over all four event streams."""
    names = list(tables or AGGREGATES)
    return (
        envelope(events)
        .writeStream.foreachBatch(lambda batch, batch_id: upsert_batch(batch, batch_id, root, names, ttl_hours))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "60 seconds"}))
        .start()
    )
