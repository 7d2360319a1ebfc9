import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from funnelwright.model import DIMENSION_KEYS
from funnelwright.operators import dims, funnel, joins, landscape, quality, serving
from funnelwright.operators.joins import frequent_summary, hot_keys, interval_join, left_join
from funnelwright.plans.views import VIEWS
from funnelwright.sources import derived

SF = "/root/testdata/sf0.001"


def timed(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("event_ts", F.timestamp_micros("us")).drop("us")


def test_interval_join_with_a_hot_key(spark):
    rng = random.Random(7)
    key = lambda: "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
    left = [(key(), i, rng.randrange(0, 4000) * 500_000) for i in range(300)]
    right = [(key(), i, rng.randrange(0, 4000) * 500_000) for i in range(300)]
    a = timed(spark, left, "k string, l int, us long").withColumnRenamed("event_ts", "lt")
    b = timed(spark, right, "k string, r int, us long").withColumnRenamed("event_ts", "rt")
    for lower, upper in ((0, 5), (-10, 5), (-10, 0), (0, 60)):
        want = sorted(
            (i, j) for k, i, t in left for q, j, u in right if k == q and lower * 10**6 <= u - t <= upper * 10**6
        )
        got = interval_join(a, b, "k", "lt", "rt", lower, upper).select("l", "r").collect()
        assert sorted(tuple(r) for r in got) == want
        matched = {i for i, _ in want}
        outer = interval_join(a, b, "k", "lt", "rt", lower, upper, "left").select("l", "r").collect()
        assert sorted(map(repr, map(tuple, outer))) == sorted(
            map(repr, want + [(i, None) for _, i, _ in left if i not in matched])
        )


def frames(spark, copies=1):
    def at(seconds):
        return 1704067200_000_000 + seconds * 1_000_000

    requests = [("q1", at(0), 1), ("q2", at(10), 1), ("q3", at(3599), None)] * copies
    responses = [("r1", "q1", at(5)), ("r2", "q2", at(16)), ("r3", "q3", at(3601))] * copies
    impressions = [("i1", "q1", "r1", 1, 2.0, at(15)), ("i2", "q1", "r1", 2, 3.0, at(16)), ("i3", "q3", "r3", 1, 5.0, at(3602))]
    clicks = [("c1", "i1", at(75)), ("c2", "i1", at(76)), ("c3", "i1", at(20)), ("c4", "i3", at(3662))]
    return (
        timed(spark, requests, "request_id string, us long, publisher_id int").withColumns(
            {"country": F.lit("USA"), "is_invalid": F.lit(False)}
        ),
        timed(spark, responses, "response_id string, request_id string, us long"),
        timed(
            spark,
            impressions * copies,
            "impression_id string, request_id string, response_id string, bidder_id int, win_price double, us long",
        ),
        timed(spark, clicks * copies, "click_id string, impression_id string, us long"),
    )


def test_funnel_bounds_and_copies(spark):
    for copies in (1, 3):
        rows = funnel.hourly_funnel(*frames(spark, copies)).orderBy("publisher_id").collect()
        got = [(r.publisher_id, r.bid_requests, r.bid_responses, r.impressions, r.clicks) for r in rows]
        # q2's response is 6 s late, i2 11 s, c2 61 s after its impression.
        assert got == [(None, 1, 1, 1, 1), (1, 2, 1, 1, 2)]
    assert rows[1].fill_rate == 0.5 and rows[1].ctr == 2.0
    lost = funnel.leakage(funnel.hourly_funnel(*frames(spark)), "window_start").filter("publisher_id = 1").first()
    assert (lost.requests_no_response, lost.responses_no_impression, lost.impressions_no_click) == (1, 0, -1)


def test_serving_repeats_impressions_per_click(spark):
    _, _, impressions, clicks = frames(spark, 2)
    row = serving.serving_per_minute(impressions, clicks).filter("bidder_id = 1").orderBy("window_start").first()
    assert (row.impressions, row.clicks, row.revenue, row.ctr) == (2, 2, 4.0, 1.0)


def test_rolling_windows(spark):
    _, _, impressions, _ = frames(spark, 2)
    rows = serving.rolling_bidder(impressions).filter("bidder_id = 2").collect()
    assert len(rows) == 5 and all(r.win_count == 1 and r.revenue == 3.0 for r in rows)


def test_quality_counts_copies(spark):
    row = quality.hourly_quality(*frames(spark, 3)).orderBy("window_start").first()
    assert (row.total_bid_requests, row.unique_bid_requests, row.duplicate_bid_requests) == (9, 3, 6)


def test_landscape_copies_of_requests_multiply_bids(spark):
    requests, responses, _, _ = frames(spark, 2)
    bids = responses.distinct().select(
        F.concat("response_id", F.lit("-b")).alias("bid_id"), "request_id", F.lit(2.0).alias("bid_price"), "event_ts"
    )
    rows = landscape.hourly_landscape(bids, requests).filter("publisher_id = 1").collect()
    assert [(r.request_count, r.total_bids, r.avg_bid_price) for r in rows] == [(2, 4, 2.0)]


def test_unmatched_bids_have_publisher_zero(spark):
    requests, responses, _, _ = frames(spark)
    bids = responses.selectExpr("response_id AS bid_id", "'nobody' AS request_id", "1.0e0 AS bid_price", "event_ts")
    assert {r.publisher_id for r in landscape.hourly_landscape(bids, requests).collect()} == {0}


def test_funnel_scans_each_input_once(spark, tmp_path):
    paths = {}
    for name in ("requests", "responses", "impressions", "clicks"):
        paths[name] = str(tmp_path / name)
        derived.STAGES[name](spark, SF).write.parquet(paths[name])
    df = funnel.hourly_funnel(*[spark.read.parquet(p) for p in paths.values()])
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 4
    assert plan.count("ReusedExchange") == 3


def test_left_join_spreads_hot_keys(spark, rows_of):
    left = spark.createDataFrame([(None, 0), ("hot", 1), ("hot", 2), ("cold", 3), ("lone", 4)], "k string, l int")
    rows = [("hot", i) for i in range(20)] + [("hot", 5)] * 7 + [("cold", 99), (None, 7)]
    right = spark.createDataFrame(rows, "k string, r int").repartition(5)
    want = left.join(right, "k", "left")
    for hot in (hot_keys(right, "k", 5), hot_keys(right, "k", 5, frequent_summary(right, "k")), hot_keys(right, "k", 50)):
        assert rows_of(left_join(left, right, "k", hot)) == rows_of(want)
    assert rows_of(left_join(left, right, "k")) == rows_of(want)
    assert [tuple(r) for r in hot_keys(right, "k", 5).collect()] == [("hot", 6)]
    # summaries of two batches are united
    both = frequent_summary(right, "k").unionByName(frequent_summary(right.limit(0), "k"))
    assert [tuple(r) for r in hot_keys(right, "k", 10, both).collect()] == [("hot", 3)]


def test_full_funnel_spreads_a_hot_impression(spark, monkeypatch, rows_of):
    tables = {n: build(spark, SF) for n, build in derived.FACTS.items()}
    tables |= {n: derived.dimension(spark, SF, n) for n in DIMENSION_KEYS}
    tables["clicks"] = tables["clicks"].cache()
    one = tables["clicks"].first()
    again = tables["clicks"].filter(F.col("click_id") == one.click_id).drop("click_id")
    again = again.crossJoin(spark.range(300).select(F.concat(F.lit("more"), "id").alias("click_id")))
    tables["clicks"] = tables["clicks"].unionByName(again)
    plain = rows_of(VIEWS["v_event_enriched_full_funnel"](tables))
    monkeypatch.setattr(joins, "HOT_ROWS", 100)
    spread = VIEWS["v_event_enriched_full_funnel"](tables)
    assert rows_of(spread) == plain
    assert "_salt" in spread._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in hot_keys(tables["clicks"], "impression_id").collect()] == [(one.impression_id, 4)]


@pytest.mark.parametrize("small", [True, False])
def test_as_of_join(spark, monkeypatch, small):
    """A thousand versions of one key, copies of a start, gaps, and facts at every border."""
    monkeypatch.setattr(dims, "BROADCAST_BYTES", 10**30 if small else -1)
    t0, hour = datetime(2024, 1, 1), timedelta(hours=1)
    versions = [(1, t0 + 2 * k * hour, t0 + (2 * k + 2) * hour if k % 5 else t0 + (2 * k + 1) * hour, f"v{k}") for k in range(1000)]
    versions += [(2, t0, None, "open"), (3, t0, None, "old"), (3, t0 + hour, None, "new"), (3, t0 + hour, t0 + 2 * hour, "short")]
    versions += [(4, None, None, "never"), (None, t0, None, "nobody")]
    schema = "k int, valid_from timestamp, valid_to timestamp, name string"
    facts = [(i, 1, t0 + timedelta(minutes=30 * i - 90)) for i in range(4010)]
    facts += [(5000 + i, k, t0 + i * hour) for k in (2, 3, 4, 5, None) for i in (-1, 0, 1, 2, 50)] + [(6000, 2, None)]
    df = spark.createDataFrame(facts, "id int, k int, ts timestamp")
    got = dims.as_of_join(df, spark.createDataFrame(versions, schema), "k", "ts", {"shown": "name"})
    want = []
    for i, k, ts in facts:
        begun = [v for v in versions if None not in (k, ts, v[0], v[1]) and v[0] == k and v[1] <= ts]
        last = max(begun, key=lambda v: (v[1], v[2] or datetime(9999, 1, 1)), default=None)
        want.append((i, k, ts, last[3] if last and (last[2] is None or ts < last[2]) else None))
    assert Counter(map(tuple, got.collect())) == Counter(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert ("Window" in plan) != small and "NestedLoop" not in plan


def test_wide_request_row_is_shuffled_once(spark, tmp_path):
    tables = {}
    for name, build in derived.FACTS.items():
        build(spark, SF).write.parquet(f"{tmp_path}/{name}")
        tables[name] = spark.read.parquet(f"{tmp_path}/{name}")
    for name in DIMENSION_KEYS:
        tables[name] = derived.dimension(spark, SF, name)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = VIEWS["v_event_enriched_full_funnel"](tables)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        hashed = re.findall(r"Exchange hashpartitioning\((\w+)#", plan.split("== Initial Plan ==")[-1])
        # the chain's six exchanges; only the last hop's left side is the request row
        assert sorted(hashed)[:6] and hashed.count("request_id") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
