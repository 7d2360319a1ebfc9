"""The standard reports and chart queries.

Reports that count joined rows first count each side per join key and then
multiply, so that no pair of rows is ever made. ``LIMIT`` is part of the
reports; further sort keys make their choice of rows stable.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import auction_name, hour_of, settle
from funnelwright.operators.funnel import funnel_summary

Tables = Mapping[str, DataFrame]


def _percent(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") / F.nullif(whole, F.lit(0)) * 100, 2)


def _volume(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("request_count"))


def requests_by_country(t: Tables) -> DataFrame:
    return (
        _volume(t["bid_requests"], "device_geo_country")
        .orderBy(F.desc("request_count"), "device_geo_country")
        .limit(10)
    )


def floor_by_region(t: Tables) -> DataFrame:
    return (
        t["bid_requests"]
        .groupBy("device_geo_country", "device_geo_region")
        .agg(settle(F.avg("imp_bidfloor"), 4).alias("avg_bidfloor"), F.count("*").alias("request_count"))
        .orderBy(F.desc("avg_bidfloor"), "device_geo_country", "device_geo_region")
        .limit(10)
    )


def floor_by_size(t: Tables) -> DataFrame:
    return (
        t["bid_requests"]
        .groupBy("imp_banner_w", "imp_banner_h")
        .agg(
            settle(F.min("imp_bidfloor"), 4).alias("min_floor"),
            settle(F.avg("imp_bidfloor"), 4).alias("avg_floor"),
            settle(F.max("imp_bidfloor"), 4).alias("max_floor"),
            F.count("*").alias("request_count"),
        )
        .orderBy(F.desc("request_count"), "imp_banner_w", "imp_banner_h")
        .limit(10)
    )


def device_breakdown(t: Tables) -> DataFrame:
    return _volume(t["bid_requests"], "device_os", "device_type").orderBy(
        F.desc("request_count"), "device_os", "device_type"
    )


def hourly_volume(t: Tables) -> DataFrame:
    hour = hour_of(F.col("event_timestamp")).alias("hour")
    return _volume(t["bid_requests"], hour).orderBy(F.desc("hour")).limit(24)


def auction_types(t: Tables) -> DataFrame:
    return (
        _volume(t["bid_requests"], "auction_type")
        .select("auction_type", auction_name(F.col("auction_type")).alias("auction_name"), "request_count")
        .orderBy(F.desc("request_count"), "auction_type")
    )


def privacy_flags(t: Tables) -> DataFrame:
    return _volume(t["bid_requests"], "is_gdpr", "is_coppa").orderBy(
        F.desc("request_count"), "is_gdpr", "is_coppa"
    )


def fill_rate_by_country(t: Tables) -> DataFrame:
    asked = t["bid_requests"].groupBy("request_id", "device_geo_country").agg(F.count("*").alias("n"))
    bids = t["bid_responses"].groupBy("request_id").agg(F.count("*").alias("m"))
    m = F.coalesce(F.col("m"), F.lit(0))
    # A row with a NULL id has no matches and is not counted, as COUNT(column) skips it.
    named = F.when(F.col("request_id").isNotNull(), F.col("n")).otherwise(F.lit(0))
    return (
        asked.join(bids, "request_id", "left")
        .groupBy("device_geo_country")
        .agg(F.sum(named * F.greatest(m, F.lit(1))).alias("requests"), F.sum(F.col("n") * m).alias("responses"))
        .withColumn("fill_rate_pct", _percent(F.col("responses"), F.col("requests")))
        .orderBy(F.desc("requests"), "device_geo_country")
        .limit(10)
    )


def _joined_counts(
    left: DataFrame, right: DataFrame, key: str, group: Column | str, left_name: str, right_name: str, rate: str
) -> DataFrame:
    """Joined left and right rows per group of a left join on ``key``."""
    ours = left.groupBy(key, group).agg(F.count(key).alias("n"))
    theirs = right.groupBy(key).agg(F.count("*").alias("m"))
    m = F.coalesce(F.col("m"), F.lit(0))
    name = ours.columns[1]
    return (
        ours.join(theirs, key, "left")
        .groupBy(name)
        .agg(
            F.sum(F.col("n") * F.greatest(m, F.lit(1))).alias(left_name),
            F.sum(F.col("n") * m).alias(right_name),
        )
        .withColumn(rate, _percent(F.col(right_name), F.col(left_name)))
    )


def win_rate_by_bidder(t: Tables) -> DataFrame:
    return _joined_counts(
        t["bid_responses"],
        t["impressions"],
        "response_id",
        F.col("seat").alias("bidder"),
        "bids",
        "wins",
        "win_rate_pct",
    ).orderBy(F.desc("bids"), "bidder")


def ctr_by_creative(t: Tables) -> DataFrame:
    return (
        _joined_counts(
            t["impressions"], t["clicks"], "impression_id", "creative_id", "impressions", "clicks", "ctr_pct"
        )
        .orderBy(F.desc("impressions"), "creative_id")
        .limit(10)
    )


def revenue_by_publisher(t: Tables) -> DataFrame:
    asked = t["bid_requests"].groupBy("request_id", "publisher_id").agg(F.count("*").alias("n"))
    won = (
        t["impressions"]
        .groupBy("request_id")
        .agg(
            F.count("impression_id").alias("m"),
            F.count("win_price").alias("priced"),
            F.sum("win_price").alias("price"),
        )
    )
    return (
        asked.join(won, "request_id")
        .groupBy("publisher_id")
        .agg(
            F.sum(F.col("n") * F.col("m")).alias("wins"),
            settle(F.sum(F.col("n") * F.col("price")), 2).alias("total_revenue"),
            settle(
                F.sum(F.col("n") * F.col("price")) / F.nullif(F.sum(F.col("n") * F.col("priced")), F.lit(0)), 4
            ).alias("avg_win_price"),
        )
        .orderBy(F.desc("total_revenue"), "publisher_id")
        .limit(10)
    )


def full_funnel_summary(t: Tables) -> DataFrame:
    counts = funnel_summary(t["bid_requests"], t["bid_responses"], t["impressions"], t["clicks"])
    return counts.select(
        F.col("bid_requests").alias("requests"),
        F.col("bid_responses").alias("responses"),
        "impressions",
        "clicks",
        _percent(F.col("bid_responses"), F.col("bid_requests")).alias("fill_rate_pct"),
        _percent(F.col("impressions"), F.col("bid_responses")).alias("win_rate_pct"),
        _percent(F.col("clicks"), F.col("impressions")).alias("ctr_pct"),
    )


def spread_by_bidder(t: Tables) -> DataFrame:
    """Mean bid, mean win price and mean spread over all (bid, impression) pairs of a response."""
    bids = (
        t["bid_responses"]
        .groupBy("response_id", F.col("seat").alias("bidder"))
        .agg(F.count("bid_price").alias("n"), F.sum("bid_price").alias("bid"))
    )
    wins = t["impressions"].groupBy("response_id").agg(
        F.count("win_price").alias("m"), F.sum("win_price").alias("win")
    )
    pairs = F.nullif(F.sum(F.col("n") * F.col("m")), F.lit(0))
    bid, win = F.sum(F.col("bid") * F.col("m")), F.sum(F.col("win") * F.col("n"))
    return (
        bids.join(wins, "response_id")
        .groupBy("bidder")
        .agg(
            settle(bid / pairs, 4).alias("avg_bid_price"),
            settle(win / pairs, 4).alias("avg_win_price"),
            settle((bid - win) / pairs, 4).alias("avg_spread"),
        )
        .orderBy(F.desc("avg_spread"), "bidder")
    )


def reject_reasons(t: Tables) -> DataFrame:
    return (
        t["dq_rejected_events"]
        .groupBy("reject_reason")
        .agg(F.count("*").alias("rejected_count"))
        .orderBy(F.desc("rejected_count"), "reject_reason")
        .limit(10)
    )


def quality_kpis(t: Tables) -> DataFrame:
    return (
        t["dq_event_quality_hourly"]
        .select(
            "window_start",
            "total_bid_requests",
            "duplicate_bid_requests",
            "duplicate_bid_request_rate",
            "total_bid_responses",
            "duplicate_bid_responses",
            "duplicate_bid_response_rate",
            "total_wins",
            "duplicate_wins",
            "duplicate_win_rate",
            "total_clicks",
            "duplicate_clicks",
            "duplicate_click_rate",
            "invalid_bid_requests",
            "invalid_bid_request_rate",
            "total_events_all",
            "duplicate_events_all",
            "duplicate_rate_all",
        )
        .orderBy(F.desc("window_start"))
        .limit(24)
    )


def auction_landscape(t: Tables) -> DataFrame:
    return (
        t["bid_landscape_hourly"]
        .select(
            "window_start",
            "publisher_id",
            "request_count",
            "total_bids",
            "bids_per_request",
            "avg_bid_price",
            "max_bid_price",
        )
        .orderBy(F.desc("window_start"), F.desc("total_bids"), "publisher_id")
        .limit(20)
    )


def minute_serving(t: Tables) -> DataFrame:
    return (
        t["realtime_serving_metrics_1m"]
        .select("window_start", "bidder_id", "impressions", "clicks", "revenue", "ctr")
        .orderBy(F.desc("window_start"), F.desc(F.round("revenue", 2)), "bidder_id")
        .limit(30)
    )


def leakage_by_publisher(t: Tables) -> DataFrame:
    return (
        t["funnel_leakage_hourly"]
        .select(
            "window_start",
            "publisher_id",
            "requests_no_response",
            "responses_no_impression",
            "impressions_no_click",
            "response_leakage_rate",
            "impression_leakage_rate",
            "click_leakage_rate",
        )
        .orderBy(F.desc("window_start"), F.desc("requests_no_response"), "publisher_id")
        .limit(20)
    )


REPORTS = {
    "q01": requests_by_country,
    "q02": floor_by_region,
    "q03": floor_by_size,
    "q04": device_breakdown,
    "q05": hourly_volume,
    "q06": auction_types,
    "q07": privacy_flags,
    "q09": fill_rate_by_country,
    "q10": win_rate_by_bidder,
    "q11": ctr_by_creative,
    "q12": revenue_by_publisher,
    "q13": full_funnel_summary,
    "q14": spread_by_bidder,
    "q15": reject_reasons,
    "q16": quality_kpis,
    "q17": auction_landscape,
    "q18": minute_serving,
    "q19": leakage_by_publisher,
}


def top_groups(df: DataFrame, key: str, metrics: dict[str, Column], limit: int, sort_by: str) -> DataFrame:
    """The groups with the largest metric; ties go to the smaller key."""
    return (
        df.groupBy(key)
        .agg(*[metric.alias(name) for name, metric in metrics.items()])
        .orderBy(F.desc(sort_by), F.asc_nulls_last(key))
        .limit(limit)
    )


def _count_chart(table: str, key: str, counted: str, limit: int):
    def chart(t: Tables) -> DataFrame:
        return top_groups(t[table], key, {"event_count": F.count(counted)}, limit, "event_count")

    return chart


def _sum_chart(table: str, key: str, columns: Sequence[str], limit: int, sort_by: str):
    def chart(t: Tables) -> DataFrame:
        return top_groups(t[table], key, {c: F.sum(c) for c in columns}, limit, sort_by)

    return chart


# chart_rolling_by_bidder adds up overlapping windows, so a win counts in each of its five.
CHARTS = {
    "chart_requests_by_country": _count_chart("bid_requests", "device_geo_country", "request_id", 100),
    "chart_responses_by_seat": _count_chart("bid_responses", "seat", "response_id", 100),
    "chart_impressions_by_bidder": _count_chart("impressions", "bidder_id", "impression_id", 100),
    "chart_clicks_by_creative": _count_chart("clicks", "creative_id", "click_id", 50),
    "chart_device_category": _count_chart("bid_requests_enriched", "device_category", "request_id", 10),
    "chart_test_traffic": _count_chart("bid_requests_enriched", "is_test_traffic", "request_id", 10),
    "chart_revenue_by_country": _sum_chart(
        "hourly_impressions_by_geo", "device_geo_country", ["total_revenue"], 20, "total_revenue"
    ),
    "chart_rolling_by_bidder": _sum_chart(
        "rolling_metrics_by_bidder", "bidder_id", ["win_count", "revenue"], 10, "win_count"
    ),
    "chart_funnel_by_publisher": _sum_chart(
        "hourly_funnel_by_publisher",
        "publisher_id",
        ["clicks", "impressions", "bid_responses", "bid_requests"],
        20,
        "bid_responses",
    ),
}
