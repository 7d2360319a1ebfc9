"""Impression-side metrics: by country, by bidder over sliding windows, per minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import hour_of, minute_of, ratio
from funnelwright.operators.joins import interval_join

# Seconds: how long before an impression its request may lie, how long after it a click.
REQUEST_LEAD, CLICK_WAIT = 10, 60

WINDOW_MINUTES, HOP_MINUTES = 5, 1


def latest(df: DataFrame, *keys: str) -> DataFrame:
    """One row per key with the largest price (where there is one) and event time.

    The aggregate combines copies map-side, so a heavily repeated event does
    not load one task.
    """
    measures = [F.max("event_ts").alias("event_ts")]
    if "win_price" in df.columns:
        measures.append(F.max("win_price").alias("win_price"))
    return df.groupBy(*keys).agg(*measures)


def hourly_geo(impressions: DataFrame, requests: DataFrame) -> DataFrame:
    """Impressions and revenue per hour and request country; takes stage frames."""
    shown = latest(impressions, "impression_id", "request_id")
    asked = requests.groupBy("request_id").agg(
        F.min("country").alias("device_geo_country"), F.max("event_ts").alias("request_ts")
    )
    return (
        interval_join(shown, asked, "request_id", "event_ts", "request_ts", -REQUEST_LEAD, 0)
        .groupBy(hour_of(F.col("event_ts")).alias("window_start"), "device_geo_country")
        .agg(
            F.count("*").alias("impression_count"),
            F.sum("win_price").alias("total_revenue"),
            F.avg("win_price").alias("avg_win_price"),
        )
    )


def rolling_bidder(impressions: DataFrame) -> DataFrame:
    """Wins and revenue per bidder over 5-minute windows that start every minute.

    Every event lies in five windows. Events are first summed per minute, so
    only those sums are copied into windows, not the events.
    """
    per_minute = (
        latest(impressions, "impression_id", "bidder_id")
        .filter(F.col("event_ts").isNotNull())
        .groupBy(minute_of(F.col("event_ts")).alias("minute"), "bidder_id")
        .agg(
            F.count("*").alias("win_count"),
            F.sum("win_price").alias("revenue"),
            F.count("win_price").alias("priced"),
        )
    )
    return (
        per_minute.groupBy(
            F.window("minute", f"{WINDOW_MINUTES} minutes", f"{HOP_MINUTES} minutes").alias("w"), "bidder_id"
        )
        .agg(
            F.sum("win_count").alias("win_count"),
            F.sum("revenue").alias("revenue"),
            F.sum("priced").alias("priced"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "bidder_id",
            "win_count",
            "revenue",
            (F.col("revenue") / F.nullif(F.col("priced"), F.lit(0))).alias("avg_cpm"),
        )
    )


def serving_per_minute(impressions: DataFrame, clicks: DataFrame) -> DataFrame:
    """Impressions, clicks, revenue and click rate per minute and bidder.

    Counts joined rows: an impression with several clicks in time counts once
    per click, and so does its price.
    """
    shown = latest(impressions, "impression_id", "bidder_id")
    clicked = latest(clicks, "click_id", "impression_id").withColumnRenamed("event_ts", "click_ts")
    joined = interval_join(shown, clicked, "impression_id", "event_ts", "click_ts", 0, CLICK_WAIT, "left")
    per_click = joined.groupBy(
        minute_of(F.col("event_ts")).alias("window_start"), "bidder_id", "click_id"
    ).agg(F.count("*").alias("n"), F.sum("win_price").alias("revenue"))
    return (
        per_click.groupBy("window_start", "bidder_id")
        .agg(
            F.sum("n").alias("impressions"),
            F.count("click_id").alias("clicks"),
            F.sum("revenue").alias("revenue"),
        )
        .withColumn("ctr", ratio(F.col("clicks"), F.col("impressions")))
    )
