"""Queries that write tables and run streams on the way to their result.

Each works in a new folder under the cluster's shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions import event_time, minute_of
from funnelwright.model import DIMENSION_KEYS, table_schema
from funnelwright.operators.ingest import FACT_BUILDERS
from funnelwright.operators.dims import current_version, load_dimension
from funnelwright.operators.stages import impression_stage
from funnelwright.plans.linkstore import store_links, stored_funnel
from funnelwright.plans.materialise import SPECS, facts_of, materialise
from funnelwright.plans.views import publisher_funnel, publisher_leakage
from funnelwright.session import work_dir
from funnelwright.sources import derived
from funnelwright.sources.events import event_files
from funnelwright.sources.tables import (
    compact,
    file_names,
    move_path,
    path_bytes,
    path_exists,
    read_table,
    remove_replaced,
    subfolders,
    with_event_date,
)
from funnelwright.streaming.deltas import STAGE_OF, funnel_counts, run_funnel
from funnelwright.streaming.ingest import start_ingest
from funnelwright.streaming.late import late_rows, start_split
from funnelwright.streaming.native import funnel_chain_stream, interval_join_stream, rolling_bidder_stream
from funnelwright.streaming.runs import AVAILABLE_NOW, appended, reopen_last, run_available, start_append, state_partitions
from funnelwright.streaming.upsert import READS, start_upserts

Query = Callable[[SparkSession, str], DataFrame]

# Events up to here are known at the first run of a materialisation.
SPLIT = "2024-01-02 12:00:00"
# A late event to move all watermarks past the data, so that every window closes.
SENTINEL_US = derived._BASE + 40 * 86400 * 1_000_000
# Parts that arrive before each run of a stream.
TWO_RUNS = ((0,), (1, 2))
# Stored rows for each partition of a stream's state, in bytes, and partitions at least.
STATE_BYTES, LEAST_STATE_PARTITIONS = 32 * 1024 * 1024, 8
# Impressions that arrive late in the query on late rows.
HELD = "%7-%"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _event_stream(spark: SparkSession, sf_dir: str, root: str, name: str, parts: int) -> DataFrame:
    """Events stored by many tasks, without a shuffle, as a stream that reads about one in ``parts`` of their files at a time."""
    rows, path = derived.EVENTS[name](spark, sf_dir), f"{root}/in/{name}"
    part = F.pmod(F.hash(rows.columns[0], "event_timestamp"), F.lit(parts))
    rows.withColumn("part", part).write.partitionBy("part").parquet(path)
    stored = [f for folder in subfolders(spark, path) for f in file_names(spark, f"{path}/{folder}") if f.endswith(".parquet")]
    return event_files(spark, name, f"{path}/*", files_per_trigger=max(1, -(-len(stored) // parts)))


def _ingested(table: str) -> Query:
    """One of the tables that a stream is ingested into, in several micro-batches."""
    stream = FACT_BUILDERS[table][0]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark, "ingest")
        source = _event_stream(spark, sf_dir, root, stream, 3)
        for query in start_ingest({stream: source}, root, f"{root}/checkpoints", AVAILABLE_NOW):
            query.awaitTermination()
        rows = spark.read.parquet(f"{root}/{table}").drop("event_date", "batch_id")
        if "site_cat" in rows.columns:
            rows = rows.withColumn("site_cat", F.array_join("site_cat", ","))
        return rows.select(*table_schema(table).fieldNames())

    return run


def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions ingested in micro-batches, of which all but the last are merged, day by day."""
    root = _folder(spark, "compaction")
    source = _event_stream(spark, sf_dir, root, "impressions", 3)
    for query in start_ingest({"impressions": source}, root, f"{root}/checkpoints", AVAILABLE_NOW):
        query.awaitTermination()
    path = f"{root}/impressions"
    days = spark.read.parquet(path).select(F.col("event_date").cast("string")).distinct().collect()  # one row a day
    for (day,) in days:
        compact(spark, path, {"event_date": day}, before_batch=2)
    remove_replaced(spark, path)
    return read_table(spark, root, "impressions").select(*table_schema("impressions").fieldNames())


def _third(ts: Column, span: tuple[int, int]) -> Column:
    """Which third of a time span a row falls into; rows without a time come first."""
    lo, hi = span
    us = F.unix_micros(ts)
    return F.when(us >= lo + 2 * (hi - lo) // 3, 2).when(us >= lo + (hi - lo) // 3, 1).otherwise(0)


class _Arrivals:
    """Rows that arrive in three parts in the order of event time, each written by many tasks.

    ``held`` is a rule on rows that come one part later than their time says.
    """

    def __init__(self, spark: SparkSession, root: str, frames: Mapping[str, DataFrame], ts: Mapping[str, Column], held: str = "false"):
        self.spark, self.root, self.schemas = spark, root, {n: df.schema for n, df in frames.items()}
        first = next(iter(frames))
        times = F.unix_micros(ts[first])
        lo, hi = frames[first].agg(F.min(times), F.max(times)).first()
        for name, rows in frames.items():
            part = _third(ts[name], (lo or 0, hi or 0))
            if name == first:
                part = F.least(part + F.expr(held).cast("int"), F.lit(2))
            rows.withColumn("arrival", part).write.partitionBy("arrival").parquet(f"{root}/parts/{name}")

    def arrive(self, *parts: int) -> None:
        """Files of these parts move to where the streams read; a part without rows is an empty file."""
        for name, schema in self.schemas.items():
            for part in parts:
                source, target = f"{self.root}/parts/{name}/arrival={part}", f"{self.root}/in/{name}/{part}"
                if path_exists(self.spark, source):
                    move_path(self.spark, source, target)
                else:
                    self.spark.createDataFrame([], schema).write.parquet(target)

    def state_partitions(self) -> int:
        """Partitions for the state of streams over these rows: few, and as many more as there are more rows."""
        return max(LEAST_STATE_PARTITIONS, -(-path_bytes(self.spark, self.root) // STATE_BYTES))

    def close(self) -> None:
        """One late event in every stream moves all watermarks past the data, so that every window closes."""
        for name, schema in self.schemas.items():
            columns = [
                F.timestamp_micros(F.lit(SENTINEL_US)).alias(f.name)
                if f.name == "event_ts"
                else F.lit(
                    f"sentinel-{name}" if f.name.endswith("_id") and f.dataType.simpleString() == "string" else None
                )
                .cast(f.dataType)
                .alias(f.name)
                for f in schema
            ]
            self.spark.range(1).select(*columns).write.parquet(f"{self.root}/in/{name}/closed")

    def streams(self) -> dict[str, DataFrame]:
        return {n: self.spark.readStream.schema(s).parquet(f"{self.root}/in/{n}/*") for n, s in self.schemas.items()}


def _event_arrivals(spark: SparkSession, sf_dir: str, root: str, names: list[str], held: str = "false") -> _Arrivals:
    """Nested events, of which only those named have rows."""
    frames = {n: derived.EVENTS[n](spark, sf_dir) for n in names}
    return _Arrivals(spark, root, frames, {n: event_time(F.col("event_timestamp")) for n in names}, held)


def _stage_arrivals(spark: SparkSession, sf_dir: str, root: str, names: list[str]) -> _Arrivals:
    frames = {n: derived.STAGES[n](spark, sf_dir) for n in names}
    return _Arrivals(spark, root, frames, {n: F.col("event_ts") for n in names})


def _upserted(table: str) -> Query:
    """An aggregate that is restated as events arrive; a new run on the same checkpoint takes up each part."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark, "upsert")
        arrivals = _event_arrivals(spark, sf_dir, root, list(READS[table]))
        for parts in TWO_RUNS:
            arrivals.arrive(*parts)
            query = start_upserts(arrivals.streams(), root, f"{root}/checkpoint", [table], AVAILABLE_NOW)
            query.awaitTermination()
        return spark.read.parquet(f"{root}/{table}").drop("window_hour")

    return run


def _appended(
    spark: SparkSession, sf_dir: str, names: list[str], build: Callable[[dict[str, DataFrame]], DataFrame]
) -> DataFrame:
    """What a stream over stage rows appends, resumed on its checkpoint for each part that arrives."""
    root = _folder(spark, "stream")
    arrivals = _stage_arrivals(spark, sf_dir, root, names)
    with state_partitions(spark, arrivals.state_partitions()):
        for parts in TWO_RUNS:
            arrivals.arrive(*parts)
            run_available(build(arrivals.streams()), root)
        arrivals.close()
        run_available(build(arrivals.streams()), root)
    return appended(build(arrivals.streams()), root)


def stream_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _appended(spark, sf_dir, ["impressions"], lambda s: rolling_bidder_stream(s["impressions"]))


def stream_click_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impressions with the clicks on them within a minute, kept where there are none."""

    def build(streams: dict[str, DataFrame]) -> DataFrame:
        clicks = streams["clicks"].withColumnRenamed("event_ts", "click_ts")
        shown = streams["impressions"].select("impression_id", "bidder_id", "win_price", "event_ts")
        return interval_join_stream(shown, clicks, "impression_id", "event_ts", "click_ts", 0, 60, "left")

    return _appended(spark, sf_dir, ["impressions", "clicks"], build).filter("impression_id NOT LIKE 'sentinel%'")


def stream_funnel_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four-stage chain, each event once."""
    names = ["requests", "responses", "impressions", "clicks"]
    rows = _appended(spark, sf_dir, names, lambda s: funnel_chain_stream(*s.values()))
    return rows.filter("request_id NOT LIKE 'sentinel%'").select(
        "request_id", "publisher_id", "event_ts", "response_id", "impression_id", "click_id"
    )


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows whose stream stops after the first part and loses its last commit.

    It resumes from the state of the batch before, repeats the batch and goes on, and
    the windows are those of a stream that never stopped.
    """
    root = _folder(spark, "restart")
    arrivals = _stage_arrivals(spark, sf_dir, root, ["impressions"])
    build = lambda: rolling_bidder_stream(arrivals.streams()["impressions"])
    arrivals.arrive(0)
    running = start_append(build(), root, {"processingTime": "0 seconds"})
    running.processAllAvailable()
    running.stop()
    reopen_last(spark, f"{root}/checkpoint")
    arrivals.arrive(1, 2)
    run_available(build(), root)
    arrivals.close()
    run_available(build(), root)
    return appended(build(), root)


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some impressions arrive a day late: what is split off, what the windows keep, what the buckets restate.

    ``late``: rows behind the watermark, per minute and bidder. ``window``: sliding windows,
    without them. ``minute``: impressions per minute as restated, with them.
    """
    root = _folder(spark, "late")
    arrivals = _event_arrivals(spark, sf_dir, root, ["impressions", "clicks"], f"impression_id LIKE '{HELD}'")
    for part in range(3):
        arrivals.arrive(part)
        streams = arrivals.streams()
        shown = impression_stage(streams["impressions"])
        start_split(shown, f"{root}/split", f"{root}/split/checkpoint", "event_ts", 30, AVAILABLE_NOW).awaitTermination()
        run_available(rolling_bidder_stream(shown), f"{root}/windows")
        table = "realtime_serving_metrics_1m"
        start_upserts(streams, root, f"{root}/checkpoint", [table], AVAILABLE_NOW).awaitTermination()
    # Windows that are still open at the end are not appended: a last event closes them.
    last = derived.EVENTS["impressions"](spark, sf_dir).limit(1)
    last = last.withColumns(
        {"event_timestamp": F.lit("2024-02-10T00:00:00+00:00"), "bidder_id": F.lit(None).cast("int")}
    )
    last.write.parquet(f"{root}/in/impressions/last")
    windows = rolling_bidder_stream(impression_stage(arrivals.streams()["impressions"]))
    run_available(windows, f"{root}/windows")

    late = late_rows(spark, f"{root}/split", shown.schema).groupBy(minute_of(F.col("event_ts")).alias("window_start"), "bidder_id").agg(F.count("*").alias("n"))
    kept = appended(windows, f"{root}/windows").select("window_start", "bidder_id", F.col("win_count").alias("n"))
    restated = spark.read.parquet(f"{root}/realtime_serving_metrics_1m")
    restated = restated.select("window_start", "bidder_id", F.col("impressions").alias("n"))
    kinds = {"late": late, "window": kept, "minute": restated}
    return reduce(DataFrame.unionByName, [df.withColumn("kind", F.lit(kind)) for kind, df in kinds.items()])


def stream_funnel_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel summed from the deltas of three parts, state and checkpoints carried between them."""
    root = _folder(spark, "delta")
    arrivals = _stage_arrivals(spark, sf_dir, root, list(STAGE_OF.values()))
    with state_partitions(spark, arrivals.state_partitions()):
        for parts in TWO_RUNS:
            arrivals.arrive(*parts)
            run_funnel(spark, arrivals.streams(), f"{root}/funnel")
    return funnel_counts(spark, f"{root}/funnel")


def _materialised(table: str, late: str | None, dims_change: bool, by_day: bool = False, **options) -> Query:
    """Load a table from part of the data, then bring it up to date with the rest.

    ``late`` is a rule on a fact's id for rows that are missing at first though
    their time is before the split. Facts kept ``by_day`` are found by the index of their ids.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark, "mat")
        spec = SPECS[table]
        after = F.col("event_timestamp") > F.lit(SPLIT).cast("timestamp")
        first, everything = {}, {}
        for name in facts_of(spec.view):
            rows = derived.FACTS[name](spark, sf_dir)
            is_late = F.expr(late.format(id=rows.columns[0])) if late else F.lit(False)
            rows = rows.withColumn("batch_id", F.when(after | is_late, 2).otherwise(1))
            days = ["event_date"] if by_day else []
            rows = with_event_date(rows) if by_day else rows
            # A few folders, so each task may write to all of them and nothing is shuffled.
            rows.write.partitionBy(*days, "batch_id").parquet(f"{root}/facts/{name}")
            stored = spark.read.parquet(f"{root}/facts/{name}")
            first[name] = stored.filter("batch_id = 1")
            everything[name] = stored
        dims = {name: derived.dimension(spark, sf_dir, name) for name in DIMENSION_KEYS}
        before = dict(dims)
        if dims_change:
            publishers = dims["dim_publisher"]
            # Every first version is current at first; second versions come with the change.
            before["dim_publisher"] = publishers.filter("valid_from < '2024-01-02'").withColumns(
                {"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
            )
        materialise(spark, spec, first | before, root)
        materialise(spark, spec, everything | dims, root, **options)
        return spark.read.parquet(f"{root}/{table}").drop("event_date")

    return run


def _on_stored_links(view: Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]) -> Query:
    """A report on the chain of ids, joined bucket by bucket over links that were stored first."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = _folder(spark, "links")
        name = "links_" + root.rsplit("-", 1)[-1]
        facts = {table: derived.FACTS[table](spark, sf_dir) for table in derived.FACTS}
        store_links(facts, spark, root, name, int(spark.conf.get("spark.sql.shuffle.partitions")))
        return view(stored_funnel(spark, name), {"dim_publisher": derived.dimension(spark, sf_dir, "dim_publisher")})

    return run


def _loaded_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First versions, then all, then both again: the stored table is that of all."""
    rows = derived.dimension(spark, sf_dir, "dim_publisher")
    first = rows.filter("valid_from < '2024-01-02'").withColumns(
        {"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    )
    root = _folder(spark, "dims")
    for load in (first, rows, first.filter("publisher_id % 2 = 0"), rows):
        load_dimension(spark, load, "dim_publisher", root)
    return current_version(read_table(spark, root, "dim_publisher"))


def stateful_queries() -> Mapping[str, Query]:
    return {
        "stream_ingest": _ingested("dq_rejected_events"),
        **{f"stream_ingest_{table}": _ingested(table) for table in FACT_BUILDERS if table != "dq_rejected_events"},
        "stream_rolling": stream_rolling,
        "stream_click_join": stream_click_join,
        "stream_funnel_chain": stream_funnel_chain,
        "stream_restart": stream_restart,
        "stream_late_rows": stream_late_rows,
        "stream_funnel_delta": stream_funnel_delta,
        "stream_funnel": _upserted("hourly_funnel_by_publisher"),
        "stream_serving": _upserted("realtime_serving_metrics_1m"),
        "stream_landscape": _upserted("bid_landscape_hourly"),
        "stream_geo": _upserted("hourly_impressions_by_geo"),
        "stream_quality": _upserted("dq_event_quality_hourly"),
        "stream_leakage": _upserted("funnel_leakage_hourly"),
        "mat_append": _materialised("mat_bid_requests", None, False),
        "mat_late_repair": _materialised(
            "mat_agg_serving_metrics", "pmod(hash({id}), 7) = 0", False
        ),
        "mat_lookback_repair": _materialised(
            "mat_impressions", "pmod(hash({id}), 7) = 0", False, lookback_hours=72
        ),
        "mat_dim_repair": _materialised("mat_agg_bid_landscape", None, True),
        **{
            table: _materialised(table, "pmod(hash({id}), 7) = 0", True)
            for table in (
                "mat_bid_responses",
                "mat_clicks",
                "mat_agg_metrics_by_bidder",
                "mat_agg_funnel_by_publisher",
                "mat_agg_funnel_leakage",
                "mat_agg_impressions_by_geo",
            )
        },
        "scd2_load": _loaded_dimension,
        "compaction": compaction,
        "stored_funnel": _on_stored_links(publisher_funnel),
        "stored_leakage": _on_stored_links(publisher_leakage),
        "mat_funnel_repair": _materialised("mat_full_funnel", "pmod(hash({id}), 7) = 0", True),
        "mat_indexed_repair": _materialised("mat_full_funnel", "pmod(hash({id}), 7) = 0", False, by_day=True),
        "mat_indexed_serving": _materialised("mat_agg_serving_metrics", "pmod(hash({id}), 7) = 0", False, by_day=True),
    }
