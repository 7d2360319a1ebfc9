"""Streams that stop, resume, meet late rows and forget old ones."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import funnel, stages
from funnelwright.sources.events import decoded, event_batch
from funnelwright.streaming import deltas, late, runs
from funnelwright.streaming.native import rolling_bidder_stream
from funnelwright.streaming.upsert import envelope, upsert_batch

T0 = datetime(2024, 1, 1, 10)
SHOWN = "impression_id string, request_id string, response_id string, bidder_id int, win_price double, event_ts timestamp"


def shown(spark, seconds, first=0):
    rows = [(f"i{first + k}", "r", "p", 1, 1.0, T0 + timedelta(seconds=s)) for k, s in enumerate(seconds)]
    return spark.createDataFrame(rows, SHOWN)


def stream_of(spark, path, schema):
    return spark.readStream.schema(schema).parquet(path)


def test_stopped_stream_resumes_and_repeats_its_last_batch(spark, tmp_path, rows_of):
    path, root = f"{tmp_path}/in", f"{tmp_path}/run"
    build = lambda: rolling_bidder_stream(stream_of(spark, path, shown(spark, []).schema))
    shown(spark, range(0, 400, 20)).write.parquet(path)
    runs.run_available(build(), root)
    first = runs.last_committed(spark, f"{root}/checkpoint")
    before = rows_of(runs.appended(build(), root))
    assert runs.reopen_last(spark, f"{root}/checkpoint") == first
    assert runs.unfinished(spark, f"{root}/checkpoint") == [first]
    runs.run_available(build(), root)
    assert runs.last_committed(spark, f"{root}/checkpoint") == first
    assert rows_of(runs.appended(build(), root)) == before
    # windows that were open when the stream stopped are counted on from their state
    shown(spark, [*range(400, 800, 20), 100_000], 100).write.mode("append").parquet(path)
    runs.run_available(build(), root)
    got = {r.window_start: r.win_count for r in runs.appended(build(), root).collect()}
    want = {}
    for s in range(0, 800, 20):
        for back in range(5):
            start = T0 + timedelta(minutes=s // 60 - back)
            want[start] = want.get(start, 0) + 1
    assert got == want
    assert runs.last_committed(spark, f"{tmp_path}/none") == -1 == runs.reopen_last(spark, f"{tmp_path}/none")


def test_late_rows_are_those_that_state_drops(spark, tmp_path):
    path, root = f"{tmp_path}/in", f"{tmp_path}/run"
    parts = [[0, 100, 200.9999], [170, 171, 171.0009, 300, 10], [270, 269.5, 1000, None]]
    dropped, number = 0, 0
    for k, seconds in enumerate(parts):
        rows = [(f"i{number + i}", "r", "p", 1, 1.0, T0 + timedelta(seconds=s) if s is not None else None) for i, s in enumerate(seconds)]
        number += len(rows)
        spark.createDataFrame(rows, SHOWN).coalesce(1).write.mode("append").parquet(path)
        stream = stream_of(spark, path, shown(spark, []).schema)
        late.start_split(stream, root, f"{root}/split", "event_ts", 30, runs.AVAILABLE_NOW).awaitTermination()
        timed = stream.filter("event_ts IS NOT NULL")
        dropped += runs.dropped_late(runs.run_available(rolling_bidder_stream(timed), f"{root}/windows"))
    split = late.late_rows(spark, root, shown(spark, []).schema).collect()
    kept = spark.read.parquet(f"{root}/on_time").collect()
    assert sorted((r.event_ts - T0).total_seconds() for r in split) == [10, 170, 269.5, 270]
    assert len(kept) + len(split) == number and len(split) == dropped
    assert {(r.watermark - T0).total_seconds() for r in split} == {170.999, 270}


def test_split_batch_is_repeatable(spark, tmp_path):
    root = str(tmp_path)
    for batch_id, seconds in [(0, [0, 500]), (1, [400, 900]), (1, [400, 900]), (2, [850, 880])]:
        late.split_batch(shown(spark, seconds, 10 * batch_id), batch_id, root, "event_ts", 30)
    split = late.late_rows(spark, root, shown(spark, []).schema)
    assert {(r.impression_id, r.batch_id) for r in split.collect()} == {("i10", 1), ("i20", 2)}
    assert spark.read.parquet(f"{root}/on_time").count() == 4
    late.split_batch(shown(spark, []), 3, root, "event_ts", 30)
    assert late.watermark(spark, root, 4, 30) == late.watermark(spark, root, 3, 30)


def chain(spark, hours, first=0, wait=1):
    """Stage rows of one event an hour each, every later stage ``wait`` seconds behind."""
    at = lambda h, stage: T0 + timedelta(hours=h, seconds=stage * wait)
    n = [(first + k, h) for k, h in enumerate(hours)]
    return {
        "requests": spark.createDataFrame(
            [(f"r{k}", at(h, 0), 7) for k, h in n], "request_id string, event_ts timestamp, publisher_id int"
        ),
        "responses": spark.createDataFrame(
            [(f"p{k}", f"r{k}", at(h, 1)) for k, h in n], "response_id string, request_id string, event_ts timestamp"
        ),
        "impressions": spark.createDataFrame(
            [(f"i{k}", f"p{k}", at(h, 2)) for k, h in n], "impression_id string, response_id string, event_ts timestamp"
        ),
        "clicks": spark.createDataFrame(
            [(f"c{k}", f"i{k}", at(h, 3)) for k, h in n], "click_id string, impression_id string, event_ts timestamp"
        ),
    }


class Feed:
    """Stage rows written to folders, and streams over these."""

    def __init__(self, spark, root):
        self.spark, self.root, self.frames = spark, root, {}

    def add(self, frames):
        for name, df in frames.items():
            df.write.mode("append").parquet(f"{self.root}/in/{name}")
            self.frames[name] = df.schema

    def run(self, ttl=deltas.TTL):
        streams = {n: stream_of(self.spark, f"{self.root}/in/{n}", s) for n, s in self.frames.items()}
        return deltas.run_funnel(self.spark, streams, f"{self.root}/funnel", ttl)

    def counts(self):
        return deltas.funnel_counts(self.spark, f"{self.root}/funnel")

    def batch(self):
        frames = {n: self.spark.read.schema(s).parquet(f"{self.root}/in/{n}") for n, s in self.frames.items()}
        return funnel.hourly_funnel(*[frames[n] for n in ("requests", "responses", "impressions", "clicks")])


def test_deltas_count_late_and_repeated_events_once(spark, tmp_path, rows_of):
    feed = Feed(spark, str(tmp_path))
    early, again = chain(spark, [0, 0, 1, 2]), chain(spark, [0, 0, 1])
    feed.add({n: df for n, df in early.items() if n != "responses"})
    feed.add({"responses": early["responses"].limit(0)})
    feed.run()
    assert [(r.bid_requests, r.bid_responses, r.clicks) for r in feed.counts().orderBy("window_start").collect()] == [
        (2, 0, 0),
        (1, 0, 0),
        (1, 0, 0),
    ]
    # the missing hop and copies of what came before arrive two hours late
    feed.add({"responses": early["responses"], "requests": again["requests"], "clicks": again["clicks"]})
    feed.run()
    feed.run()
    got = feed.counts()
    assert rows_of(got.select(*feed.batch().columns)) == rows_of(feed.batch())
    assert got.agg(F.sum("clicks")).first()[0] == 4
    day = deltas.funnel_counts(spark, f"{tmp_path}/funnel", "2024-01-01", "2024-01-01")
    assert rows_of(day) == rows_of(got) and deltas.funnel_counts(spark, f"{tmp_path}/funnel", "2024-01-02").count() == 0


def test_state_expires_and_a_batch_costs_its_own_ids(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.add(chain(spark, [0] * 400))
    full = [runs.state_rows(q)[-1] for q in feed.run()[:-1]]
    assert full[0] == 400 and min(full[1:]) >= 400
    feed.add(chain(spark, [0.5] * 3, 1000))
    more = feed.run()
    # three events of the same hour read three rows and three links, however many the hour has
    assert [sum(p["numInputRows"] for p in q.recentProgress) for q in more] == [3, 6, 6, 6, 12]
    assert feed.counts().collect()[0].bid_requests == 403
    feed.add(chain(spark, [30] * 2, 2000))
    feed.run()
    feed.add(chain(spark, [31] * 2, 3000))
    left = [runs.state_rows(q)[-1] for q in feed.run()[:-1]]
    assert all(rows <= 20 for rows in left)


def test_landed_rows_expire_with_the_batches(spark, tmp_path, rows_of):
    root, table = str(tmp_path), "hourly_funnel_by_publisher"

    def batch(hours, first):
        frames = chain(spark, hours, first)
        rows = None
        for stage, df in frames.items():
            df = df.withColumn("stage", F.lit(stage))
            rows = df if rows is None else rows.unionByName(df, allowMissingColumns=True)
        empty = envelope({"bid_requests": event_batch(spark, "bid_requests", f"{root}/none")})
        return empty.unionByName(rows, allowMissingColumns=True)

    spark.createDataFrame([], "id string").write.parquet(f"{root}/none")
    hours = lambda: sorted({r[0] for r in spark.read.parquet(f"{root}/landed").select("event_hour").collect()})
    for k, at in enumerate([[0, 1, 2], [3, 0.5], [26, 2.9], [27, 1, 5]]):
        upsert_batch(batch(at, 10 * k), k, root, [table])
    # the last batch ran under the watermark of hour 2: hours from two before it on are in reach
    assert [h[-5:] for h in hours()] == ["01-10", "01-11", "01-12", "01-13", "01-15", "02-12", "02-13"]
    upsert_batch(batch([28], 50), 4, root, [table])
    upsert_batch(batch([28], 50), 4, root, [table])
    assert hours()[0] == "2024-01-01-11"
    counts = {r.window_start.hour + 24 * (r.window_start.day - 1): r.clicks for r in spark.read.parquet(f"{root}/{table}").collect()}
    assert counts == {10: 2, 11: 1, 12: 2, 13: 1, 15: 1, 36: 1, 37: 1, 38: 1}
    expired = spark.read.parquet(f"{root}/expired")
    assert {r.request_id for r in expired.filter("stage = 'requests'").collect()} == {"r31"}


def test_null_seats_lose_no_bids(spark, tmp_path):
    schema = event_batch(spark, "bid_responses", str(tmp_path)).schema
    bid = lambda k: {"id": f"b{k}", "price": 1.0 * k}
    seats = [
        [{"seat": None, "bid": None}, {"seat": 1, "bid": [bid(1)]}],
        [None, {"seat": 1, "bid": [bid(2), bid(3)]}, {"seat": 2, "bid": []}],
        [{"seat": 1, "bid": None}],
        None,
    ]
    rows = [
        {"id": f"p{k}", "seatbid": s, "event_timestamp": "2024-01-01T00:00:00Z", "ext": {"request_id": f"r{k}"}}
        for k, s in enumerate(seats)
    ]
    responses = spark.createDataFrame(rows, schema)
    assert [r.bid_id for r in stages.bid_stage(responses).orderBy("bid_id").collect()] == ["b1", "b2", "b3"]
    landed = envelope({"bid_responses": responses})
    assert [r.bid_id for r in landed.select(F.explode("bids").alias("b")).select("b.bid_id").orderBy("bid_id").collect()] == ["b1", "b2", "b3"]


@pytest.mark.parametrize("name", ["clicks", "bid_responses"])
def test_messages_decode_from_json(spark, tmp_path, name):
    schema = event_batch(spark, name, str(tmp_path)).schema
    key = schema.fieldNames()[0]
    values = [bytearray(f'{{"{key}": "a", "event_timestamp": "2024-01-01T00:00:00Z", "more": 1}}'.encode()), bytearray(b"\xff{")]
    got = decoded(spark.createDataFrame([(v,) for v in values], "value binary"), name).collect()
    assert got[0][key] == "a" and got[0].event_timestamp == "2024-01-01T00:00:00Z"
    assert len(got) == 2 and all(v is None for v in got[1])
