"""Hourly event quality: totals, duplicates and invalid requests."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import hour_of, ratio

# Kind of event: names of its total, unique, duplicate and rate columns.
_KINDS = {
    "request": ("total_bid_requests", "unique_bid_requests", "duplicate_bid_requests", "duplicate_bid_request_rate"),
    "response": (
        "total_bid_responses",
        "unique_bid_responses",
        "duplicate_bid_responses",
        "duplicate_bid_response_rate",
    ),
    "win": ("total_wins", "unique_wins", "duplicate_wins", "duplicate_win_rate"),
    "click": ("total_clicks", "unique_clicks", "duplicate_clicks", "duplicate_click_rate"),
}


def hourly_quality(
    requests: DataFrame, responses: DataFrame, impressions: DataFrame, clicks: DataFrame
) -> DataFrame:
    """Quality metrics per hour over all four streams; takes stage frames.

    Each stream counts the copies of each id of an hour, with map-side combine, and
    folds them to one row an hour; only those rows are united. There is no spine of
    hours to join to.
    """

    def folded(df: DataFrame, kind: str, id_column: str) -> DataFrame:
        invalid = F.col("is_invalid") if "is_invalid" in df.columns else F.lit(False)
        events = df.select(
            hour_of(F.col("event_ts")).alias("window_start"),
            F.col(id_column).alias("id"),
            invalid.cast("int").alias("invalid"),
        )
        per_id = events.groupBy("window_start", "id").agg(F.count("*").alias("n"), F.max("invalid").alias("invalid"))
        return per_id.groupBy("window_start").agg(
            F.lit(kind).alias("kind"),
            F.sum("n").alias("total"),
            F.count("id").alias("unique"),
            F.count(F.when((F.col("invalid") == 1) & F.col("id").isNotNull(), 1)).alias("broken"),
        )

    kinds = reduce(
        DataFrame.unionByName,
        [
            folded(requests, "request", "request_id"),
            folded(responses, "response", "response_id"),
            folded(impressions, "win", "impression_id"),
            folded(clicks, "click", "click_id"),
        ],
    )
    measures = [F.sum("broken").alias("invalid_bid_requests")]
    for kind, (total, unique, _, _) in _KINDS.items():
        here = F.col("kind") == kind
        measures.append(F.coalesce(F.sum(F.when(here, F.col("total"))), F.lit(0)).alias(total))
        measures.append(F.coalesce(F.sum(F.when(here, F.col("unique"))), F.lit(0)).alias(unique))
    hourly = kinds.groupBy("window_start").agg(*measures)

    columns = [F.col("window_start")]
    for total, unique, duplicate, rate in _KINDS.values():
        copies = F.col(total) - F.col(unique)
        columns += [F.col(total), F.col(unique), copies.alias(duplicate), ratio(copies, F.col(total)).alias(rate)]
    all_events = sum((F.col(names[0]) for names in _KINDS.values()), F.lit(0))
    all_copies = sum((F.col(names[0]) - F.col(names[1]) for names in _KINDS.values()), F.lit(0))
    columns += [
        F.col("invalid_bid_requests"),
        ratio(F.col("invalid_bid_requests"), F.col("total_bid_requests")).alias("invalid_bid_request_rate"),
        all_events.alias("total_events_all"),
        all_copies.alias("duplicate_events_all"),
        ratio(all_copies, all_events).alias("duplicate_rate_all"),
    ]
    return hourly.filter(F.col("window_start").isNotNull()).select(*columns)
