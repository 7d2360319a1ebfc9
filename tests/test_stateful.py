"""How the stateful queries lay out what their streams read and keep."""

import os
from glob import glob

from pyspark.sql import functions as F

import stateful_queries as q
from funnelwright.sources import derived
from funnelwright.streaming import runs
from funnelwright.streaming.native import rolling_bidder_stream

SF = "/root/testdata/sf0.001"


def test_a_batch_of_the_ingest_has_files_of_many_tasks(spark, tmp_path, monkeypatch):
    events = derived.impression_events(spark, SF)
    monkeypatch.setitem(derived.EVENTS, "impressions", lambda *_: events.repartition(5))
    stream = q._event_stream(spark, SF, str(tmp_path), "impressions", 3)
    assert len(glob(f"{tmp_path}/in/impressions/*/*.parquet")) > 5
    query = runs.run_available(stream, f"{tmp_path}/run")
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    got = runs.appended(stream, f"{tmp_path}/run")
    assert got.exceptAll(events).isEmpty() and events.exceptAll(got).isEmpty()


def test_parts_are_stored_once_and_moved(spark, tmp_path):
    rows = derived.impression_stage(spark, SF)
    arrivals = q._Arrivals(spark, str(tmp_path), {"impressions": rows}, {"impressions": F.col("event_ts")})
    arrivals.arrive(0)
    arrivals.arrive(1, 2)
    assert not glob(f"{tmp_path}/parts/impressions/arrival=*") and not os.path.exists(f"{tmp_path}/known")
    stored = spark.read.schema(rows.schema).parquet(f"{tmp_path}/in/impressions/*")
    assert stored.exceptAll(rows).isEmpty() and rows.exceptAll(stored).isEmpty()


def test_state_has_the_partitions_it_was_started_with(spark, tmp_path):
    rows, path, root = derived.impression_stage(spark, SF), f"{tmp_path}/in", f"{tmp_path}/run"
    rows.write.parquet(path)
    stream = spark.readStream.schema(rows.schema).parquet(path)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with runs.state_partitions(spark, 2):
        runs.run_available(rolling_bidder_stream(stream), root)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    folders = {os.path.basename(f) for f in glob(f"{root}/checkpoint/state/0/*")}
    assert {f for f in folders if f.isdigit()} == {"0", "1"}


def test_state_of_few_batches_has_few_partitions_and_no_changes_to_repeat(spark, tmp_path, monkeypatch, rows_of):
    arrivals = q._stage_arrivals(spark, SF, str(tmp_path), ["impressions"])
    with monkeypatch.context() as m:
        m.setattr(q, "path_bytes", lambda spark, path: 2_560 * 1024 * 1024)
        assert arrivals.state_partitions() == 80
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in q.TWO_RUNS:
        arrivals.arrive(*parts)
        with runs.state_partitions(spark, 2):
            shown = arrivals.streams()["impressions"].withWatermark("event_ts", "30 seconds")
            runs.run_available(shown.dropDuplicatesWithinWatermark(["impression_id"]), str(tmp_path))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert not [*tmp_path.glob("checkpoint/state/**/*.changelog")]
    got = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(got) == rows_of(derived.impression_stage(spark, SF).distinct().select(*got.columns))
