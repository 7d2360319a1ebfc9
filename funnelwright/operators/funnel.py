"""Funnel and leakage metrics over request -> response -> impression -> click.

The left-join chain that defines the funnel multiplies bids, impressions and
clicks of a request, only to count distinct ids of each stage afterwards.
Here every stage is first reduced to its distinct links, then joined to the
groups reached so far, so rows never exceed the distinct ids of a stage.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.functions import hour_of, ratio
from funnelwright.operators.joins import edges, interval_join, named

# Longest wait in seconds from a stage to the next one.
RESPONSE_WAIT, IMPRESSION_WAIT, CLICK_WAIT = 5, 10, 60

STAGES = ("bid_requests", "bid_responses", "impressions", "clicks")


def _count_stages(stages: list[DataFrame], group: list[str]) -> DataFrame:
    """Distinct ids per group and stage, one column per stage."""
    rows = reduce(
        DataFrame.unionByName,
        [
            df.select(*group, F.lit(i).alias("stage"), F.col(df.columns[-1]).alias("id"))
            for i, df in enumerate(stages)
        ],
    )
    return count_ids(rows, group, STAGES)


def count_ids(rows: DataFrame, group: list[str], stages: Sequence[str]) -> DataFrame:
    """Distinct ids per group of rows (group, stage, id), one column per stage.

    One distinct column per aggregate keeps Spark from multiplying rows by
    the number of counts.
    """
    counts = rows.groupBy(*group, "stage").agg(F.count_distinct("id").alias("n"))
    return counts.groupBy(*group).agg(
        *[
            F.coalesce(F.max(F.when(F.col("stage") == i, F.col("n"))), F.lit(0)).alias(name)
            for i, name in enumerate(stages)
        ]
    )


def stage_rates(counts: DataFrame) -> DataFrame:
    """Add fill, win and click rates to counts of the four stages."""
    return counts.withColumns(
        {
            "fill_rate": ratio(F.col("bid_responses"), F.col("bid_requests")),
            "win_rate": ratio(F.col("impressions"), F.col("bid_responses")),
            "ctr": ratio(F.col("clicks"), F.col("impressions")),
        }
    )


def hourly_funnel(
    requests: DataFrame, responses: DataFrame, impressions: DataFrame, clicks: DataFrame
) -> DataFrame:
    """Time-bounded funnel per request hour and publisher.

    Takes stage frames. Rows without an id or a readable event time belong to
    no window and are left out.
    """
    group = ["window_start", "publisher_id"]
    base = (
        named(requests.select("request_id", "event_ts", "publisher_id"), "request_id", "event_ts")
        .distinct()
        .withColumn("window_start", hour_of(F.col("event_ts")))
    )
    answered = (
        interval_join(
            base,
            edges(responses, "response_id", "request_id", "event_ts").withColumnRenamed("event_ts", "response_ts"),
            "request_id",
            "event_ts",
            "response_ts",
            0,
            RESPONSE_WAIT,
        )
        .select(*group, "response_ts", "response_id")
        .distinct()
    )
    won = (
        interval_join(
            answered,
            edges(impressions, "impression_id", "response_id", "event_ts").withColumnRenamed(
                "event_ts", "impression_ts"
            ),
            "response_id",
            "response_ts",
            "impression_ts",
            0,
            IMPRESSION_WAIT,
        )
        .select(*group, "impression_ts", "impression_id")
        .distinct()
    )
    clicked = interval_join(
        won,
        edges(clicks, "click_id", "impression_id", "event_ts").withColumnRenamed("event_ts", "click_ts"),
        "impression_id",
        "impression_ts",
        "click_ts",
        0,
        CLICK_WAIT,
    ).select(*group, "click_id")
    stages = [base.select(*group, "request_id"), answered, won, clicked]
    return stage_rates(_count_stages(stages, group))


def linked_funnel(
    requests: DataFrame, responses: DataFrame, impressions: DataFrame, clicks: DataFrame
) -> DataFrame:
    """Funnel by id links alone, per request hour and publisher; takes flat tables."""
    group = ["hour_start", "publisher_id"]
    hour = hour_of(F.col("event_timestamp")).alias("hour_start")
    base = named(requests.select(hour, "publisher_id", "request_id"), "request_id").distinct()
    answered = (
        base.join(edges(responses, "request_id", "response_id"), "request_id").select(*group, "response_id").distinct()
    )
    won = (
        answered.join(edges(impressions, "response_id", "impression_id"), "response_id")
        .select(*group, "impression_id")
        .distinct()
    )
    clicked = won.join(edges(clicks, "impression_id", "click_id"), "impression_id").select(*group, "click_id")
    return stage_rates(_count_stages([base, answered, won, clicked], group))


def leakage(funnel: DataFrame, time_column: str) -> DataFrame:
    """Stage-to-stage losses from funnel counts; no second pass over events."""
    no_response = F.col("bid_requests") - F.col("bid_responses")
    no_impression = F.col("bid_responses") - F.col("impressions")
    no_click = F.col("impressions") - F.col("clicks")
    return funnel.select(
        time_column,
        "publisher_id",
        no_response.alias("requests_no_response"),
        no_impression.alias("responses_no_impression"),
        no_click.alias("impressions_no_click"),
        ratio(no_response, F.col("bid_requests")).alias("response_leakage_rate"),
        ratio(no_impression, F.col("bid_responses")).alias("impression_leakage_rate"),
        ratio(no_click, F.col("impressions")).alias("click_leakage_rate"),
    )


def funnel_summary(
    requests: DataFrame, responses: DataFrame, impressions: DataFrame, clicks: DataFrame
) -> DataFrame:
    """Whole-table funnel in one row.

    Impressions hang on the request here, not on the response. Both sides of
    each join are distinct, so an inner join tests for existence; a semi join
    would be moved below the distinct and shuffle the copies as well.
    """
    base = edges(requests, "request_id")
    answered = base.join(edges(responses, "request_id"), "request_id")
    won = (
        edges(impressions, "request_id", "impression_id")
        .join(base, "request_id")
        .select("impression_id")
        .distinct()
    )
    clicked = edges(clicks, "impression_id", "click_id").join(won, "impression_id").select("click_id")
    return _count_stages([base, answered, won, clicked], [])
