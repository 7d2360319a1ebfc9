"""Narrow projections of the raw streams: only what the aggregates read.

The aggregates work on raw events, before any quality filter. Parquet prunes
nested fields, so a stage frame reads just these leaves of the wide events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import event_time, is_private_ip
from funnelwright.operators.ingest import device_ip, publisher_id


def _event_ts() -> Column:
    return event_time(F.col("event_timestamp")).alias("event_ts")


def seat_bids() -> Column:
    """The bids of all seats in one array. A seat without a list of bids has none; the others keep theirs."""
    return F.flatten(F.filter(F.col("seatbid.bid"), lambda bids: bids.isNotNull()))


def request_stage(requests: DataFrame) -> DataFrame:
    """request_id, event_ts, publisher_id, country, is_invalid; one row per event.

    A request is invalid if it has a slot and fails any quality rule, once
    however many slots fail.
    """
    low_floor = F.exists("imp.bidfloor", lambda floor: floor <= 0)
    broken = (
        F.coalesce(publisher_id() < 0, F.lit(False))
        | F.coalesce(is_private_ip(device_ip()), F.lit(False))
        | F.coalesce(low_floor, F.lit(False))
    )
    has_slot = F.coalesce(F.size("imp.bidfloor") > 0, F.lit(False))
    return requests.select(
        F.col("id").alias("request_id"),
        _event_ts(),
        publisher_id().alias("publisher_id"),
        F.col("device.geo.country").alias("country"),
        (has_slot & broken).alias("is_invalid"),
    )


def response_stage(responses: DataFrame, *more: Column) -> DataFrame:
    """response_id, request_id, event_ts and what else is asked for; one row per event."""
    return responses.select(
        F.col("id").alias("response_id"), F.col("ext.request_id").alias("request_id"), _event_ts(), *more
    )


def bid_stage(responses: DataFrame) -> DataFrame:
    """bid_id, request_id, bid_price, event_ts; one row per bid of every seat."""
    bids = F.explode(seat_bids()).alias("bid")
    return responses.select(F.col("ext.request_id").alias("request_id"), _event_ts(), bids).select(
        F.col("bid.id").alias("bid_id"), "request_id", F.col("bid.price").alias("bid_price"), "event_ts"
    )


def impression_stage(impressions: DataFrame) -> DataFrame:
    return impressions.select("impression_id", "request_id", "response_id", "bidder_id", "win_price", _event_ts())


def click_stage(clicks: DataFrame) -> DataFrame:
    return clicks.select("click_id", "impression_id", _event_ts())


# Every stage frame with the stream it is cut from.
STAGES = {
    "requests": ("bid_requests", request_stage),
    "responses": ("bid_responses", response_stage),
    "bids": ("bid_responses", bid_stage),
    "impressions": ("impressions", impression_stage),
    "clicks": ("clicks", click_stage),
}
