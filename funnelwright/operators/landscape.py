"""Auction landscape: bids per request and their prices, by hour and publisher."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import hour_of, ratio
from funnelwright.operators.joins import interval_join

# A response may lie this many seconds before or after its request.
BEFORE_REQUEST, AFTER_REQUEST = 5, 10


def _summarise(matched: DataFrame, group: list[str]) -> DataFrame:
    """From (group, request_id, copies, bids, priced, price_sum, price_max) to metrics.

    ``copies`` is how often the request side holds that row. Counting by it
    gives the joined-row counts without making the rows.
    """
    copies = F.coalesce(F.col("copies"), F.lit(1))
    per_request = matched.groupBy(*group, "request_id").agg(
        F.sum(F.col("bids") * copies).alias("bids"),
        F.sum(F.col("priced") * copies).alias("priced"),
        F.sum(F.col("price_sum") * copies).alias("price_sum"),
        F.max("price_max").alias("price_max"),
    )
    return (
        per_request.groupBy(*group)
        .agg(
            F.count("request_id").alias("request_count"),
            F.sum("bids").alias("total_bids"),
            (F.sum("price_sum") / F.nullif(F.sum("priced"), F.lit(0))).alias("avg_bid_price"),
            F.max("price_max").alias("max_bid_price"),
        )
        .select(
            *group,
            "request_count",
            "total_bids",
            ratio(F.col("total_bids"), F.col("request_count")).alias("bids_per_request"),
            "avg_bid_price",
            "max_bid_price",
        )
    )


def _bid_sums(bids: DataFrame, *keys) -> DataFrame:
    return bids.groupBy(*keys).agg(
        F.count("*").alias("bids"),
        F.count("bid_price").alias("priced"),
        F.sum("bid_price").alias("price_sum"),
        F.max("bid_price").alias("price_max"),
    )


def hourly_landscape(bids: DataFrame, requests: DataFrame) -> DataFrame:
    """Time-bounded landscape per response hour; publisher 0 where no request matches.

    Takes stage frames. Bids are unique by (bid, request); requests are not
    made unique, so copies of a request count its bids again.
    """
    unique = bids.groupBy("bid_id", "request_id").agg(
        F.max("bid_price").alias("bid_price"), F.max("event_ts").alias("event_ts")
    )
    offers = _bid_sums(unique, "request_id", "event_ts")
    asked = requests.groupBy("request_id", F.col("event_ts").alias("request_ts"), "publisher_id").agg(
        F.count("*").alias("copies")
    )
    matched = interval_join(
        offers, asked, "request_id", "event_ts", "request_ts", -AFTER_REQUEST, BEFORE_REQUEST, "left"
    ).select(
        hour_of(F.col("event_ts")).alias("window_start"),
        F.coalesce("publisher_id", F.lit(0)).alias("publisher_id"),
        "request_id",
        "copies",
        "bids",
        "priced",
        "price_sum",
        "price_max",
    )
    return _summarise(matched, ["window_start", "publisher_id"])


def linked_landscape(bids: DataFrame, requests: DataFrame) -> DataFrame:
    """Landscape by id links alone; takes flat tables. Unmatched bids have no publisher."""
    offers = _bid_sums(bids, hour_of(F.col("event_timestamp")).alias("hour_start"), "request_id")
    asked = requests.groupBy("request_id", "publisher_id").agg(F.count("*").alias("copies"))
    return _summarise(offers.join(asked, "request_id", "left"), ["hour_start", "publisher_id"])
