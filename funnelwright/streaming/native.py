"""Stateful streams: sliding windows and time-bounded joins kept in state.

The watermark bounds the state: rows more than 30 seconds behind the newest
event are late and dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.operators.funnel import CLICK_WAIT, IMPRESSION_WAIT, RESPONSE_WAIT
from funnelwright.operators.serving import HOP_MINUTES, WINDOW_MINUTES

LATENESS = "30 seconds"


def rolling_bidder_stream(impressions: DataFrame) -> DataFrame:
    """Sliding windows per bidder over a stream of impression stage rows.

    Copies of an impression within the watermark are dropped, keeping the
    first, which equals any other copy. The event time stays an event time.
    """
    window = F.window("event_ts", f"{WINDOW_MINUTES} minutes", f"{HOP_MINUTES} minutes").alias("w")
    return (
        impressions.withWatermark("event_ts", LATENESS)
        .dropDuplicatesWithinWatermark(["impression_id", "bidder_id"])
        .groupBy(window, "bidder_id")
        .agg(
            F.count("*").alias("win_count"),
            F.sum("win_price").alias("revenue"),
            F.avg("win_price").alias("avg_cpm"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "bidder_id",
            "win_count",
            "revenue",
            "avg_cpm",
        )
    )


def interval_join_stream(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, lower: int, upper: int, how: str
) -> DataFrame:
    """Stream-stream join where right_ts lies in [left_ts + lower, left_ts + upper] seconds.

    Both watermarks and the bounds let Spark drop state. Columns other than
    ``key`` must differ between the sides.
    """
    ours = left.withWatermark(left_ts, LATENESS)
    theirs = right.withWatermark(right_ts, LATENESS).withColumnRenamed(key, "_right_key")
    condition = (
        (F.col(key) == F.col("_right_key"))
        & (F.col(right_ts) >= F.col(left_ts) + F.expr(f"interval {lower} seconds"))
        & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {upper} seconds"))
    )
    return ours.join(theirs, condition, how).drop("_right_key")


def _untagged(ts: str, alias: str):
    """The same time, no longer marked as an event time."""
    return F.timestamp_micros(F.unix_micros(ts)).alias(alias)


def funnel_chain_stream(
    requests: DataFrame, responses: DataFrame, impressions: DataFrame, clicks: DataFrame
) -> DataFrame:
    """The three-hop left chain of stage streams, each event once.

    A chained stream join allows one event time. That is the request's; the
    times of later stages are carried as plain values, with the exact bound
    of each hop as a further test. The bound from the request clock follows
    from the sum of the hops. Rows that miss a stage get a key for the next one
    from their request, which matches no event but spreads them, since a
    stateful join keeps all rows of one key, NULL too, in one state partition.
    """
    chain = (
        requests.select("request_id", "publisher_id", "event_ts")
        .withWatermark("event_ts", LATENESS)
        .dropDuplicatesWithinWatermark(["request_id"])
    )
    hops = [
        (responses, "request_id", "response_id", "response_ts", RESPONSE_WAIT),
        (impressions, "response_id", "impression_id", "impression_ts", IMPRESSION_WAIT),
        (clicks, "impression_id", "click_id", "click_ts", CLICK_WAIT),
    ]
    previous, since_request = "event_ts", 0
    for events, key, id_column, ts, wait in hops:
        since_request += wait
        side = (
            events.select(
                F.col(key).alias("_key"), F.col(id_column).alias(f"_{id_column}"), F.col("event_ts").alias("_ts")
            )
            .withWatermark("_ts", LATENESS)
            .dropDuplicatesWithinWatermark([f"_{id_column}"])
        )
        chain = chain.withColumn("_link", F.coalesce(key, F.concat(F.lit("\x00missing-"), "request_id")))
        condition = (
            (F.col("_link") == F.col("_key"))
            & (F.col("_ts") >= F.col("event_ts"))
            & (F.col("_ts") <= F.col("event_ts") + F.expr(f"interval {since_request} seconds"))
            & (F.unix_micros("_ts") - F.unix_micros(previous)).between(0, wait * 1_000_000)
        )
        chain = chain.join(side, condition, "left").select(
            *[c for c in chain.columns if c != "_link"], F.col(f"_{id_column}").alias(id_column), _untagged("_ts", ts)
        )
        previous = ts
    return chain
