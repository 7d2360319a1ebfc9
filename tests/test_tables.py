from collections.abc import Mapping
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from funnelwright.operators import dims, funnel, stages
from funnelwright.plans import keyindex
from funnelwright.plans.materialise import SPECS, materialise, read_watermark
from funnelwright.plans.views import VIEWS
from funnelwright.sources import derived
from funnelwright.sources.tables import (
    append_facts,
    compact,
    create_table,
    read_table,
    remove_replaced,
    replace_partitions,
    time_range,
    with_event_date,
)
from funnelwright.streaming.ingest import write_batch
from funnelwright.streaming.upsert import envelope, expire_landed, upsert_batch

SF = "/root/testdata/sf0.001"


def test_replace_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id % 2 AS p").write.partitionBy("p").parquet(path)
    fresh = spark.range(100, 103).selectExpr("id", "0L AS p")
    for _ in range(2):
        replace_partitions(fresh, path, ["p"])
        got = sorted(r.id for r in spark.read.parquet(path).collect())
        assert got == [1, 3, 5, 7, 9, 100, 101, 102]


def test_compaction_and_pruned_ranges(spark, tmp_path, rows_of):
    root = str(tmp_path)
    facts = derived.impression_facts(spark, SF).repartition(6)
    append_facts(facts, root, "impressions")
    append_facts(facts.limit(0), root, "impressions")
    before = rows_of(read_table(spark, root, "impressions"))
    assert compact(spark, f"{root}/impressions", {"event_date": "2024-01-01"}) == 1
    assert rows_of(read_table(spark, root, "impressions")) == before
    assert len(list((tmp_path / "impressions" / "event_date=2024-01-01").glob("*.parquet"))) == 1
    stored = spark.read.parquet(f"{root}/impressions")
    lo, hi = datetime(2024, 1, 2, 5), datetime(2024, 1, 2, 6)
    part = time_range(stored, lo, hi)
    assert part.count() == facts.filter(F.col("event_timestamp").between(F.lit(lo), F.lit(hi))).count()
    assert "PartitionFilters: [isnotnull(event_date" in part._jdf.queryExecution().executedPlan().toString()


def test_dimension_load_and_versions(spark, tmp_path):
    root = str(tmp_path)
    rows = derived.dimension(spark, SF, "dim_publisher")
    for _ in range(2):
        assert dims.load_dimension(spark, rows, "dim_publisher", root).count() == 34
    first = rows.filter("valid_from < '2024-01-02'")
    merged = dims.apply_changes(first, rows.filter("valid_from >= '2024-01-02'"), "publisher_id")
    current = merged.filter("is_current").select("publisher_id", "publisher_name").collect()
    # publisher 24 is retired, and a load of other keys does not bring it back
    assert len(current) == 24 and sum(r.publisher_name.endswith("v2") for r in current) == 9
    facts = spark.sql(
        "SELECT 1 AS publisher_id, timestamp'2024-01-01 23:59:59' AS ts UNION ALL SELECT 1, timestamp'2024-01-02'"
        " UNION ALL SELECT 99, timestamp'2024-01-02'"
    )
    joined = dims.as_of_join(facts, merged, "publisher_id", "ts", {"name": "publisher_name"}).orderBy("publisher_id", "ts")
    assert [r.name for r in joined.collect()] == ["NATION_0 Media", "NATION_0 Media v2", None]


def test_dimension_load_closes_and_retires(spark, tmp_path):
    rows = derived.dimension(spark, SF, "dim_publisher")
    opened = {"valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}
    first = rows.filter("valid_from < '2024-01-02'").withColumns(opened)
    for load in (first, rows, first.limit(0), rows):
        stored = dims.load_dimension(spark, load, "dim_publisher", str(tmp_path))
    counts = stored.groupBy("publisher_id").agg(F.sum(F.col("is_current").cast("int")).alias("n")).collect()
    assert len(counts) == 25 and all(r.n == int(r.publisher_id != 24) for r in counts)
    assert stored.count() == 34 and stored.exceptAll(rows.select(*stored.columns)).isEmpty()


def test_ingest_batch_is_repeatable(spark, tmp_path):
    events = derived.bid_request_events(spark, SF)
    for _ in range(2):
        write_batch(events, 0, "bid_requests", str(tmp_path))
    stored = read_table(spark, str(tmp_path), "bid_requests")
    assert stored.count() == derived.request_facts(spark, SF).count()


def test_compaction_of_ingested_batches(spark, tmp_path, rows_of):
    root = str(tmp_path)
    events = derived.bid_request_events(spark, SF)
    parts = [events.filter(F.expr(f"pmod(hash(id), 4) = {k}")) for k in range(4)]
    want = derived.request_facts(spark, SF)
    path = f"{root}/bid_requests"

    def seen():
        return rows_of(read_table(spark, root, "bid_requests").select(*want.columns))

    for k in (0, 1):
        write_batch(parts[k], k, "bid_requests", root)
    before = seen()
    early = read_table(spark, root, "bid_requests").select(*want.columns)
    days = [r[0] for r in spark.read.parquet(path).select(F.col("event_date").cast("string")).distinct().collect()]
    files = len(spark.read.parquet(path).inputFiles())
    for day in days:
        compact(spark, path, {"event_date": day}, before_batch=2)
        assert seen() == before  # some days merged, their batches still there
    assert rows_of(early) == before  # a reader from before the markers
    remove_replaced(spark, path)
    assert seen() == before
    assert len(read_table(spark, root, "bid_requests").inputFiles()) < files
    for k in (2, 1, 3):  # 1 is a late retry
        write_batch(parts[k], k, "bid_requests", root)
    for _ in range(2):
        compact(spark, path, {"event_date": days[0]}, before_batch=3)
    assert seen() == rows_of(want)
    remove_replaced(spark, path)
    assert seen() == rows_of(want)
    one_day = read_table(spark, root, "bid_requests").filter(F.col("event_date") == days[0])
    assert {r.batch_id for r in one_day.select("batch_id").distinct().collect()} == {2, 3}
    assert compact(spark, path, {"event_date": "1999-01-01"}, before_batch=3) == 0


def test_compaction_without_its_marker_changes_nothing(spark, tmp_path, rows_of):
    root = str(tmp_path)
    for k in (0, 1):
        write_batch(derived.impression_events(spark, SF).filter(F.expr(f"pmod(hash(impression_id), 2) = {k}")), k, "impressions", root)
    before = rows_of(read_table(spark, root, "impressions"))
    compact(spark, f"{root}/impressions", {"event_date": "2024-01-01"}, before_batch=2)
    marker = tmp_path / "_compacted" / "impressions" / "run=0" / "_SUCCESS"
    marker.unlink()  # as if the run had been stopped
    assert rows_of(read_table(spark, root, "impressions")) == before
    compact(spark, f"{root}/impressions", {"event_date": "2024-01-01"}, before_batch=2)
    assert marker.exists()
    assert rows_of(read_table(spark, root, "impressions").drop("batch_id")) == rows_of(
        spark.read.parquet(f"{root}/impressions").drop("batch_id")
    )


def test_late_click_updates_the_hour_of_its_request(spark, tmp_path, rows_of):
    root = str(tmp_path)
    events = {}
    for name, build in derived.EVENTS.items():
        build(spark, SF).write.parquet(f"{root}/in/{name}")
        events[name] = spark.read.parquet(f"{root}/in/{name}")
    early = events | {"clicks": events["clicks"].filter("click_id LIKE '%-0'")}
    late = {n: df.filter("false") for n, df in events.items()} | {"clicks": events["clicks"].filter("click_id LIKE '%-1'")}
    table, losses = "hourly_funnel_by_publisher", "funnel_leakage_hourly"
    upsert_batch(envelope(early), 0, root, [table, losses], ttl_hours=None)
    for _ in range(2):
        upsert_batch(envelope(late), 1, root, [table, losses], ttl_hours=None)
    want = funnel.hourly_funnel(
        *[stages.STAGES[s][1](events[stages.STAGES[s][0]]) for s in ("requests", "responses", "impressions", "clicks")]
    )
    got = spark.read.parquet(f"{root}/{table}").select(*want.columns)
    assert rows_of(got) == rows_of(want)
    hours = [r[0] for r in spark.read.parquet(f"{root}/landed").select("event_hour").distinct().orderBy("event_hour").collect()]
    assert expire_landed(spark, root, datetime.strptime(hours[2], "%Y-%m-%d-%H")) >= 2
    left = spark.read.parquet(f"{root}/landed").select("event_hour").distinct().orderBy("event_hour").collect()
    assert [r[0] for r in left] == hours[2:] and expire_landed(spark, f"{root}/none", datetime(2024, 1, 1)) == 0
    lost = funnel.leakage(want, "window_start")
    assert rows_of(spark.read.parquet(f"{root}/{losses}").select(*lost.columns)) == rows_of(lost)


def test_interrupted_materialisation_recovers(spark, tmp_path, rows_of):
    root = str(tmp_path)
    spec = SPECS["mat_clicks"]
    derived.click_facts(spark, SF).write.parquet(f"{root}/clicks")
    clicks = spark.read.parquet(f"{root}/clicks")
    tables = {d: derived.dimension(spark, SF, d) for d in ("dim_bidder", "dim_creative")}
    early = tables | {"clicks": clicks.filter("event_timestamp <= '2024-01-02 12:00:00'")}
    materialise(spark, spec, early, root)
    first = read_watermark(spark, root, spec.table)
    # A stage left by a run that stopped after deleting a day of the table.
    path, day = f"{root}/{spec.table}", "2024-01-02"
    stored = spark.read.parquet(path).filter(F.col("event_date") == day)
    stored.write.partitionBy("event_date").parquet(f"{root}/_staging/{spec.table}")
    spark.read.parquet(path).filter(F.col("event_date") != day).write.partitionBy("event_date").parquet(f"{root}/copy")
    create_table(spark.read.parquet(f"{root}/copy"), path, ["event_date"])
    everything = tables | {"clicks": clicks}
    for _ in range(2):
        materialise(spark, spec, everything, root)
    got = spark.read.parquet(path).drop("event_date")
    assert rows_of(got) == rows_of(VIEWS[spec.view](everything).select(*got.columns))
    assert read_watermark(spark, root, spec.table) > first


class Live(Mapping):
    """Tables that are read anew on each access, as those of a running system."""

    def __init__(self, tables):
        self.now = dict(tables)

    def __getitem__(self, name):
        return self.now[name]

    def __iter__(self):
        return iter(self.now)

    def __len__(self):
        return len(self.now)


def live_impressions(spark, root):
    derived.impression_facts(spark, SF).write.parquet(f"{root}/impressions")
    tables = {d: derived.dimension(spark, SF, d) for d in ("dim_bidder", "dim_creative")}
    return Live(tables | {"impressions": spark.read.parquet(f"{root}/impressions")})


def names_shown(spark, root):
    return {r[0][:3] for r in spark.read.parquet(f"{root}/mat_impressions").select("bidder_name").distinct().collect() if r[0]}


def renamed(dim, prefix):
    return dim.withColumn("bidder_name", F.concat(F.lit(prefix), F.col("bidder_id").cast("string")))


def test_dimension_replaced_during_a_run_is_repaired_by_the_next(spark, tmp_path, monkeypatch, rows_of):
    root, spec = str(tmp_path), SPECS["mat_impressions"]
    tables, view = live_impressions(spark, root), VIEWS[SPECS["mat_impressions"].view]
    old, new = renamed(tables["dim_bidder"], "old"), renamed(tables["dim_bidder"], "new")

    def overtaken(seen):
        rows = view(seen)
        tables.now["dim_bidder"] = new
        return rows

    for start in (old, renamed(tables["dim_bidder"], "mid")):
        tables.now["dim_bidder"] = start
        with monkeypatch.context() as m:
            m.setitem(VIEWS, spec.view, overtaken)
            materialise(spark, spec, tables, root)
        materialise(spark, spec, tables, root)
        assert names_shown(spark, root) == {"new"}
    got = spark.read.parquet(f"{root}/{spec.table}").drop("event_date")
    assert rows_of(got) == rows_of(view(tables).select(*got.columns))


def test_manifest_of_an_interrupted_run_is_published_with_its_stage(spark, tmp_path, monkeypatch):
    """A name changes and changes back, and the run in between stops after it staged its rows."""
    root, spec = str(tmp_path), SPECS["mat_impressions"]
    tables = live_impressions(spark, root)
    first = tables.now["dim_bidder"] = renamed(tables["dim_bidder"], "one")
    materialise(spark, spec, tables, root)
    tables.now["dim_bidder"] = renamed(first, "two")

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr("funnelwright.plans.materialise.replace_partitions", stopped)
        with pytest.raises(RuntimeError):
            materialise(spark, spec, tables, root)
    tables.now["dim_bidder"] = first
    materialise(spark, spec, tables, root)
    assert names_shown(spark, root) == {"one"}


def landed(spark, root, batches):
    """Facts stored by day and batch, of the batches up to one; a rule tells the batch of a row."""
    for name, build in derived.FACTS.items():
        rows = with_event_date(build(spark, SF)).withColumn("batch_id", F.expr(batches.format(id=build(spark, SF).columns[0])))
        rows.write.mode("overwrite").partitionBy("event_date", "batch_id").parquet(f"{root}/facts/{name}")
    return lambda last: {n: spark.read.parquet(f"{root}/facts/{n}").filter(F.col("batch_id") <= last) for n in derived.FACTS}


def partition_filters(df):
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "PartitionFilters" in line]


def test_ids_name_the_days_that_hold_them(spark, tmp_path):
    root = str(tmp_path)
    facts = landed(spark, root, "IF(pmod(hash({id}), 5) = 0, 2, 1)")
    keyindex.extend_index(spark, facts(1), root)
    every = facts(2)
    shown = every["impressions"]
    assert shown.select("event_date").distinct().count() > 2
    one = shown.filter("batch_id = 1 AND event_date = '2024-01-02'").orderBy("impression_id").limit(1)
    near = keyindex.holding(spark, root, facts(1), "impressions", "impression_id", one)
    assert [r[0].isoformat() for r in near.select("event_date").distinct().collect()] == ["2024-01-02"]
    assert any("2024-01-02" in line and "2024-01-01" not in line for line in partition_filters(near))
    # the index lags behind a batch, so the days of that batch are read as well
    behind = keyindex.days_holding(spark, root, every, "impressions", "impression_id", one)
    later = shown.filter("batch_id = 2").select("event_date")
    assert {r[0] for r in later.collect()} <= {r[0] for r in behind.collect()}
    for _ in range(2):
        keyindex.extend_index(spark, every, root)
    assert keyindex.covered(spark, root, "impressions") == 2
    rows = keyindex.days_holding(spark, root, every, "impressions", "impression_id", one).collect()
    assert [r[0].isoformat() for r in rows] == ["2024-01-02"]
    # every id is found on the day it is on, unknown and null ids on none, and untracked facts are read whole
    held = spark.read.parquet(f"{root}/key_index/clicks").filter("link = 'impression_id'")
    want = every["clicks"].filter("impression_id IS NOT NULL").select(F.xxhash64("impression_id"), "event_date").distinct()
    assert held.select("id_hash", "event_date").distinct().exceptAll(want).isEmpty() and held.count() >= want.count()
    none = spark.sql("SELECT CAST(NULL AS string) AS impression_id UNION ALL SELECT 'unknown'")
    assert keyindex.holding(spark, root, every, "clicks", "impression_id", none).isEmpty()
    whole = every | {"clicks": every["clicks"].drop("event_date")}
    assert keyindex.holding(spark, root, whole, "clicks", "impression_id", none) is whole["clicks"]


def test_repair_by_key_reads_few_days(spark, tmp_path, monkeypatch, rows_of):
    """One late click of the first day: the funnel is repaired from the days of its chain."""
    root, spec = str(tmp_path), SPECS["mat_full_funnel"]
    click = derived.click_facts(spark, SF).filter("event_timestamp < '2024-01-01 20:00:00'").orderBy("click_id").first()
    facts = landed(spark, root, f"IF({{id}} = '{click.click_id}', 2, 1)")
    names = {dim for dim, _ in spec.dims}
    dimensions = {name: derived.dimension(spark, SF, name) for name in names}
    materialise(spark, spec, facts(1) | dimensions, root)
    materialise(spark, spec, facts(1) | dimensions, root)
    seen, view = {}, VIEWS[spec.view]

    def watched(tables):
        seen.update(tables)
        return view(tables)

    with monkeypatch.context() as m:
        m.setitem(VIEWS, spec.view, watched)
        materialise(spark, spec, facts(2) | dimensions, root)
    every = facts(2)
    for name in ("bid_responses", "impressions", "clicks"):
        assert any("event_date" in line and "isnull" in line for line in partition_filters(seen[name])), name
        assert 0 < seen[name].count() < every[name].count()
    got = spark.read.parquet(f"{root}/{spec.table}").drop("event_date")
    assert got.filter(F.col("click_id") == click.click_id).count() > 0
    assert rows_of(got) == rows_of(view(every | dimensions).select(*got.columns))
