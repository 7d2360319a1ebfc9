"""Keeping materialised views up to date as data arrives, arrives late, or changes.

A run finds the rows a change can affect by one predicate. The same predicate
drops rows from the table and picks rows from the view, so no row is lost or
doubled. A manifest pins the dimensions and batches that a run goes by. The
partitions it touches are first staged in full, then published, and the manifest
last; after an interrupted run the next one publishes its stage and its manifest
before it goes on.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions import hour_of
from funnelwright.operators.joins import sized_broadcast
from funnelwright.plans.keyindex import HOPS, days_of_keys, extend_index, holding, linked_sources, on_days
from funnelwright.plans.views import VIEWS
from funnelwright.session import BRIEF_SHUFFLES, settings
from funnelwright.sources.tables import (
    create_table,
    delete_path,
    move_path,
    path_exists,
    publish_partitions,
    replace_partitions,
    table_exists,
)

Tables = Mapping[str, DataFrame]
WATERMARKS = "materialization_watermarks"
MARKS = "materialization_marks"
# Column of facts that tells which batch landed them, as the ingest writes it.
BATCH = "batch_id"
# Rows of at most so many days are written by the tasks that made them, a file a day each; of more days they are
# shuffled by day first, so that there are few files.
DIRECT_DAYS = 8

# The fact whose rows drive each view: one output row or more for each, in its hour.
DRIVERS = {
    "v_event_enriched_bid_requests": "bid_requests",
    "v_event_enriched_bid_responses": "bid_responses",
    "v_event_enriched_impressions": "impressions",
    "v_event_enriched_clicks": "clicks",
    "v_event_enriched_full_funnel": "bid_requests",
    "v_agg_metrics_by_bidder": "impressions",
    "v_agg_bid_landscape": "bid_responses",
    "v_agg_serving_metrics": "impressions",
    "v_agg_funnel_by_publisher": "bid_requests",
    "v_agg_funnel_leakage": "bid_requests",
    "v_agg_impressions_by_geo": "impressions",
}
FACTS = ("bid_requests", "bid_responses", "impressions", "clicks")


def facts_of(view: str) -> list[str]:
    """The facts that a view reads: its driving one and those that it reaches by links."""
    return [DRIVERS[view], *[fact for fact, _, _ in HOPS.get(view, ())]]


@dataclass(frozen=True)
class Spec:
    """A materialised table: its view, time column and the dimensions it shows.

    Each dimension comes with the pairs of (row column, dimension column) that
    link to it. ``hourly`` marks aggregates, whose time column is an hour.
    """

    table: str
    view: str
    ts: str
    dims: tuple[tuple[str, tuple[tuple[str, str], ...]], ...]
    hourly: bool = False


def _same(*columns: str) -> dict[str, tuple[tuple[str, str], ...]]:
    return {f"dim_{c.removesuffix('_id')}": ((c, c),) for c in columns}


_REQUEST_DIMS = _same("publisher_id") | {
    "dim_device_type": (("device_type", "device_type_code"),),
    "dim_device_os": (("device_os", "os_name"),),
    "dim_geo": (("device_geo_country", "country_code"), ("device_geo_region", "region_code")),
}
_BID_DIMS = {"dim_bidder": (("seat", "bidder_id"),)} | _same(
    "creative_id", "strategy_id", "line_item_id", "campaign_id", "advertiser_id", "agency_id", "deal_id"
)
_SERVED_DIMS = _same("bidder_id", "creative_id")


def _spec(table: str, view: str, ts: str, dims: dict, hourly: bool = False) -> Spec:
    return Spec(table, view, ts, tuple(dims.items()), hourly)


SPECS = {
    spec.table: spec
    for spec in (
        _spec("mat_bid_requests", "v_event_enriched_bid_requests", "event_timestamp", _REQUEST_DIMS),
        _spec("mat_bid_responses", "v_event_enriched_bid_responses", "event_timestamp", _BID_DIMS),
        _spec("mat_impressions", "v_event_enriched_impressions", "event_timestamp", _SERVED_DIMS),
        _spec("mat_clicks", "v_event_enriched_clicks", "event_timestamp", _SERVED_DIMS),
        _spec(
            "mat_full_funnel", "v_event_enriched_full_funnel", "request_timestamp", _REQUEST_DIMS | _BID_DIMS
        ),
        _spec("mat_agg_metrics_by_bidder", "v_agg_metrics_by_bidder", "hour_start", _same("bidder_id"), True),
        _spec("mat_agg_bid_landscape", "v_agg_bid_landscape", "hour_start", _same("publisher_id"), True),
        _spec("mat_agg_serving_metrics", "v_agg_serving_metrics", "hour_start", _same("bidder_id"), True),
        _spec(
            "mat_agg_funnel_by_publisher", "v_agg_funnel_by_publisher", "hour_start", _same("publisher_id"), True
        ),
        _spec("mat_agg_funnel_leakage", "v_agg_funnel_leakage", "hour_start", _same("publisher_id"), True),
        _spec(
            "mat_agg_impressions_by_geo",
            "v_agg_impressions_by_geo",
            "hour_start",
            {"dim_geo": (("device_geo_country", "country_code"),)},
            True,
        ),
    )
}


def read_watermark(spark: SparkSession, root: str, table: str):
    """When the table's data ends, or None before its first load."""
    if not table_exists(spark, root, WATERMARKS):
        return None
    rows = spark.read.parquet(f"{root}/{WATERMARKS}").filter(F.col("table_name") == table)
    return rows.agg(F.max("last_materialized_at")).first()[0]


def write_watermark(spark: SparkSession, root: str, table: str, at) -> None:
    row = spark.createDataFrame([(table, at)], "table_name string, last_materialized_at timestamp")
    replace_partitions(row, f"{root}/{WATERMARKS}", ["table_name"])


def _dated(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("event_date", F.to_date(ts))


def read_marks(spark: SparkSession, root: str, table: str) -> dict[str, int]:
    """The last batch of each fact that the table has seen."""
    if not table_exists(spark, root, MARKS):
        return {}
    rows = spark.read.parquet(f"{root}/{MARKS}").filter(F.col("table_name") == table).collect()
    return {r.fact: r.batch for r in rows}


def last_batches(tables: Tables) -> dict[str, int]:
    """The last batch that each fact holds, where the landing keeps track of them."""
    tracked = [name for name in FACTS if name in tables and BATCH in tables[name].columns]
    found = {name: tables[name].agg(F.max(F.col(BATCH).cast("bigint"))).first()[0] for name in tracked}
    return {name: -1 if at is None else at for name, at in found.items()}


def write_marks(spark: SparkSession, root: str, table: str, marks: Mapping[str, int]) -> None:
    if marks:
        rows = spark.createDataFrame([(table, f, b) for f, b in marks.items()], "table_name string, fact string, batch bigint")
        replace_partitions(rows, f"{root}/{MARKS}", ["table_name"])


def arrivals(tables: Tables, marks: Mapping[str, int]) -> dict[str, DataFrame]:
    """Rows that landed in batches after the marks, of facts that tell their batch."""
    return {
        name: tables[name].filter(F.col(BATCH) > marks.get(name, -1))
        for name in FACTS
        if name in tables and BATCH in tables[name].columns
    }


def _shown(dim: DataFrame) -> DataFrame:
    """What views can show of a dimension: its current versions."""
    return dim.filter("is_current").drop("valid_from", "valid_to", "is_current")


def _snapshot(root: str, spec: Spec, dim: str) -> str:
    return f"{root}/_dims/{spec.table}/{dim}"


def _manifest(root: str, spec: Spec) -> str:
    return f"{root}/_staging/{spec.table}_run"


def open_run(spark: SparkSession, spec: Spec, tables: Tables, root: str) -> dict[str, DataFrame]:
    """Pin what a run reads before it reads it: the dimensions, staged, and the last batch of each fact.

    Returns the tables with the staged dimensions in place, so that the changes
    found, the rows shown and the snapshots kept are of one state, whatever is loaded
    meanwhile. A batch that lands meanwhile is taken again by the next run.
    """
    manifest = _manifest(root, spec)
    delete_path(spark, manifest)
    marks = last_batches(tables)
    pinned = dict(tables)
    for dim, _ in spec.dims:
        rows = pinned[dim]
        create_table(rows, f"{manifest}/{dim}")
        pinned[dim] = spark.read.schema(rows.schema).parquet(f"{manifest}/{dim}")
    create_table(spark.createDataFrame(list(marks.items()), "fact string, batch bigint"), f"{manifest}/marks")
    return pinned


def close_run(spark: SparkSession, spec: Spec, root: str) -> None:
    """After the rows are published: keep what the run showed and saw, as it was pinned."""
    manifest = _manifest(root, spec)
    if not path_exists(spark, f"{manifest}/marks/_SUCCESS"):
        return
    for dim, _ in spec.dims:
        create_table(_shown(spark.read.parquet(f"{manifest}/{dim}")), _snapshot(root, spec, dim))
    write_marks(spark, root, spec.table, {r.fact: r.batch for r in spark.read.parquet(f"{manifest}/marks").collect()})
    delete_path(spark, manifest)


def changed_dimensions(spark: SparkSession, spec: Spec, tables: Tables, root: str) -> dict[str, DataFrame]:
    """Current versions that differ from those the last run showed.

    Compared by content, so a version counts whenever it was loaded and whenever
    it became valid, and so does one that was retired.
    """
    out = {}
    for dim, _ in spec.dims:
        now, path = _shown(tables[dim]), _snapshot(root, spec, dim)
        if path_exists(spark, f"{path}/_SUCCESS"):
            before = spark.read.schema(now.schema).parquet(path)
            now = now.exceptAll(before).unionByName(before.exceptAll(now))
        out[dim] = now
    return out


def write_days(rows: DataFrame, path: str, spec: Spec, driving: DataFrame) -> None:
    """Write a view's rows by day; ``driving`` has every day that they can have.

    The rows of a view that is no aggregate are as many as its facts and wider, so a shuffle of them
    would be the largest of the run.
    """
    direct = False
    if not spec.hourly:
        direct = driving.select(F.to_date("event_timestamp")).distinct().count() <= DIRECT_DAYS
    create_table(rows, path, ["event_date"], gather=not direct)


def full_load(spark: SparkSession, spec: Spec, tables: Tables, root: str) -> None:
    """Build the table from its view."""
    path = f"{root}/{spec.table}"
    pinned = open_run(spark, spec, tables, root)
    write_days(_dated(VIEWS[spec.view](pinned), spec.ts), path, spec, tables[DRIVERS[spec.view]])
    end = spark.read.parquet(path).agg(F.max(spec.ts)).first()[0]
    if end is not None:
        close_run(spark, spec, root)
        write_watermark(spark, root, spec.table, end)


def late_request_ids(spark: SparkSession, tables: Tables, arrived: Tables, root: str) -> DataFrame:
    """Requests whose chain gains rows from newly arrived events of later stages."""

    def responses(keys: DataFrame) -> DataFrame:
        near = holding(spark, root, tables, "bid_responses", "response_id", keys)
        return near.join(keys, "response_id", "left_semi").select("request_id")

    keys = []
    if "bid_responses" in arrived:
        keys.append(arrived["bid_responses"].select("request_id"))
    if "impressions" in arrived:
        new = arrived["impressions"].select("response_id")
        keys.append(responses(new))
    if "clicks" in arrived:
        new = arrived["clicks"].select("impression_id")
        near = holding(spark, root, tables, "impressions", "impression_id", new)
        keys.append(responses(near.join(new, "impression_id", "left_semi").select("response_id")))
    if "bid_requests" in arrived:
        keys.append(arrived["bid_requests"].select("request_id"))
    return reduce(DataFrame.unionByName, keys).distinct()


def touched_hours(spark: SparkSession, spec: Spec, tables: Tables, arrived: Tables, root: str) -> DataFrame:
    """Hours of an aggregate that newly arrived events change, also through links."""
    driver, links = {
        "v_agg_metrics_by_bidder": ("impressions", {}),
        "v_agg_serving_metrics": ("impressions", {"clicks": "impression_id"}),
        "v_agg_impressions_by_geo": ("impressions", {"bid_requests": "request_id"}),
        "v_agg_bid_landscape": ("bid_responses", {"bid_requests": "request_id"}),
        "v_agg_funnel_by_publisher": ("bid_requests", None),
        "v_agg_funnel_leakage": ("bid_requests", None),
    }[spec.view]
    facts = tables[driver]
    found = []
    if driver in arrived:
        found.append(arrived[driver])
    if links is None:
        links, arrived = {"late": "request_id"}, {"late": late_request_ids(spark, tables, arrived, root)}
    for t, key in links.items():
        if t in arrived:
            near = holding(spark, root, tables, driver, key, arrived[t].select(key))
            found.append(near.join(arrived[t], key, "left_semi"))
    hours = [df.select(hour_of(F.col("event_timestamp")).alias("hour")) for df in found]
    if not hours:
        return facts.select(hour_of(F.col("event_timestamp")).alias("hour")).limit(0)
    return reduce(DataFrame.unionByName, hours).distinct()


def _marked(rows: DataFrame, keys: DataFrame, on: list[tuple[str, str]], mark: str) -> DataFrame:
    """Left join that adds a mark to rows whose columns are among the keys."""
    side = keys.select(*[F.col(key).alias(f"_{mark}_{key}") for _, key in on]).distinct().withColumn(mark, F.lit(True))
    condition = reduce(Column.__and__, [F.col(row) == F.col(f"_{mark}_{key}") for row, key in on])
    return rows.join(sized_broadcast(side), condition, "left").drop(*[f"_{mark}_{key}" for _, key in on])


def _since(df: DataFrame, test: Column, at, ts: str) -> DataFrame:
    """Rows whose time passes the test against ``at``; also filters the day column so that partitions are pruned."""
    out = df.filter(test)
    return out.filter(F.col("event_date") >= F.to_date(at)) if "event_date" in df.columns else out


def driven_rows(
    facts: DataFrame, mark_keys: list, spec: Spec, recent, at, days: list | None = None
) -> DataFrame | None:
    """Rows of the driving fact that the view's hit rows come from; None if keys lie on other facts.

    New rows are found by day; rows for a key by one semi join, among the ``days``
    that can hold it where those are known. An aggregate's hour or key takes all its
    rows, so groups stay whole.
    """
    ts = F.col("event_timestamp")
    time = F.date_trunc("hour", ts) if spec.hourly else ts
    facts = facts.withColumn("_time", time)
    new = F.coalesce(recent(F.col("_time")), F.lit(True))
    parts = [_since(facts, recent(F.col("_time")), at, "_time"), facts.filter(F.col("_time").isNull())]
    others = facts.filter(~new)
    if days is not None:
        others = on_days(others, days)
    found = None
    for i, (keys, on) in enumerate(mark_keys):
        columns = [(F.date_trunc("hour", ts) if row == spec.ts and key == "hour" else F.col(row), row, key) for row, key in on]
        if any(row not in facts.columns and key != "hour" for _, row, key in columns):
            return None
        side = keys.select(*[F.col(key).alias(f"_k{i}_{key}") for _, _, key in columns])
        test = reduce(Column.__and__, [column == F.col(f"_k{i}_{key}") for column, _, key in columns])
        side = sized_broadcast(side.distinct().withColumn(f"_in{i}", F.lit(True)))
        others = others.join(side, test, "left").drop(*[f"_k{i}_{key}" for _, _, key in columns])
        found = F.col(f"_in{i}").isNotNull() if found is None else found | F.col(f"_in{i}").isNotNull()
    if found is not None:
        parts.append(others.filter(found))
    names = [c for c in facts.columns if c != "_time"]
    return reduce(DataFrame.unionByName, [p.select(*names) for p in parts])


def materialise(
    spark: SparkSession,
    spec: Spec,
    tables: Tables,
    root: str,
    lookback_hours: int = 0,
    arrived: Tables | None = None,
    dim_changes: Tables | None = None,
) -> None:
    """Bring one table up to date; the shuffles of each step go before the next begins."""
    with settings(spark, BRIEF_SHUFFLES):
        _materialise(spark, spec, tables, root, lookback_hours, arrived, dim_changes)


def _materialise(
    spark: SparkSession,
    spec: Spec,
    tables: Tables,
    root: str,
    lookback_hours: int,
    arrived: Tables | None,
    dim_changes: Tables | None,
) -> None:
    """Bring one table up to date.

    By default late events are found by the batches that facts tell
    (``batch_id``), and changed dimension versions by comparing them with what
    the last run showed. ``arrived`` and ``dim_changes`` pass either in. Facts
    that do not tell their batch are repaired only in the ``lookback_hours``
    before the watermark.
    """
    path, stage = f"{root}/{spec.table}", f"{root}/_staging/{spec.table}"
    watermark = read_watermark(spark, root, spec.table)
    if watermark is None or not table_exists(spark, root, spec.table):
        full_load(spark, spec, tables, root)
        return
    if path_exists(spark, f"{stage}/_SUCCESS"):
        publish_partitions(spark, stage, path)
        close_run(spark, spec, root)  # of the run that staged it
        delete_path(spark, stage)

    tables = open_run(spark, spec, tables, root)
    extend_index(spark, tables, root)
    stored = spark.read.parquet(path)
    if arrived is None:
        arrived = arrivals(tables, read_marks(spark, root, spec.table))
    arrived = {name: rows for name, rows in arrived.items() if not rows.isEmpty()}
    if dim_changes is None:
        dim_changes = changed_dimensions(spark, spec, tables, root)
    mark_keys: list[tuple[DataFrame, list[tuple[str, str]]]] = []
    for dim, on in spec.dims:
        changes = dim_changes.get(dim)
        if changes is not None and not changes.isEmpty():
            mark_keys.append((changes, list(on)))
    if arrived and spec.table == "mat_full_funnel":
        mark_keys.append((late_request_ids(spark, tables, arrived, root), [("request_id", "request_id")]))
    elif arrived and spec.hourly:
        mark_keys.append((touched_hours(spark, spec, tables, arrived, root), [(spec.ts, "hour")]))
    elif DRIVERS[spec.view] in arrived:
        late = arrived[DRIVERS[spec.view]]
        key = {"clicks": "click_id", "impressions": "impression_id", "bid_responses": "response_id"}.get(
            DRIVERS[spec.view], "request_id"
        )
        mark_keys.append((late.select(key), [(key, key)]))

    # The hour that was open at the last run has grown since, so aggregates redo it.
    at = F.lit(watermark)
    if lookback_hours:
        at = at - F.make_dt_interval(hours=F.lit(lookback_hours))
    inclusive = spec.hourly or bool(lookback_hours)

    def recent(ts: Column) -> Column:
        return ts >= at if inclusive else ts > at

    keys_root = f"{root}/_staging/{spec.table}_keys"
    for i, (keys, on) in enumerate(mark_keys):
        # Each key set is computed once, for both splits.
        create_table(keys.select(*[key for _, key in on]).distinct(), f"{keys_root}/{i}")
        mark_keys[i] = (spark.read.parquet(f"{keys_root}/{i}"), on)

    def split(rows: DataFrame) -> DataFrame:
        hit = recent(F.col(spec.ts))
        for i, (keys, on) in enumerate(mark_keys):
            rows = _marked(rows, keys, on, f"_mark{i}")
            hit = hit | F.coalesce(F.col(f"_mark{i}"), F.lit(False))
        rows = rows.withColumn("_hit", F.coalesce(hit, F.lit(True)))
        return rows.drop(*[f"_mark{i}" for i in range(len(mark_keys))])

    # The view runs over those rows of its driving fact that can be hit, and no others.
    sources = dict(tables)
    driver = DRIVERS[spec.view]
    days = days_of_keys(spark, root, tables, driver, mark_keys)
    narrowed = driven_rows(tables[driver], mark_keys, spec, recent, at, days)
    if narrowed is not None:
        sources[driver] = narrowed
        if days is not None:
            sources = linked_sources(spark, root, spec.view, sources)

    # Fresh rows are written once, day by day; finding their days must not compute the view again.
    fresh_path = f"{root}/_staging/{spec.table}_fresh"
    made = VIEWS[spec.view](sources)
    if narrowed is None or spec.hourly:
        made = split(made).filter("_hit").drop("_hit")
    # Else every row keeps the time and the keys of the hit row it comes from, and need not meet the keys again.
    rows = _dated(made, spec.ts)
    write_days(rows, fresh_path, spec, tables[driver])
    fresh, old = spark.read.schema(rows.schema).parquet(fresh_path), split(stored)
    # One row per day: a bounded list.
    ends = {r[0]: r[1] for r in fresh.groupBy("event_date").agg(F.max(spec.ts)).collect()}
    days = list(ends.keys() | {r[0] for r in old.filter("_hit").select("event_date").distinct().collect()})
    if days:
        # Rows that stay lie in files of their day, so they join the fresh ones without a shuffle.
        kept = old.filter(F.col("event_date").isin(days)).filter("NOT _hit").select(*rows.columns)
        kept.write.mode("append").partitionBy("event_date").parquet(fresh_path)
        delete_path(spark, stage)
        move_path(spark, fresh_path, stage)
        publish_partitions(spark, stage, path)
        end = max((at for at in ends.values() if at is not None), default=None)
        if end is not None:
            write_watermark(spark, root, spec.table, max(end, watermark))
    close_run(spark, spec, root)
    for folder in (stage, fresh_path, keys_root):
        delete_path(spark, folder)
