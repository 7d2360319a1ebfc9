"""Staged partitions are published by moving them; repairs read the facts of their view only."""

import time

import pytest
from pyspark.sql import functions as F

from funnelwright.model import DIMENSION_KEYS
from funnelwright.plans import materialise as m
from funnelwright.plans.views import VIEWS
from funnelwright.sources import derived
from funnelwright.sources.tables import file_names, publish_partitions

SF = "/root/testdata/sf0.001"


def test_publishing_moves_files_and_can_be_repeated(spark, tmp_path, rows_of):
    stage, path = f"{tmp_path}/stage", f"{tmp_path}/table"
    rows = lambda name: spark.range(6).select("id", F.lit(name).alias("name"), (F.col("id") % 3).alias("day"))
    rows("old").write.partitionBy("day").parquet(path)
    rows("new").filter("day > 0").write.partitionBy("day").parquet(stage)
    files = {day: file_names(spark, f"{stage}/day={day}") for day in (1, 2)}
    # a run that stopped between the days: one of them is in place already
    rows("new").filter("day = 1").write.partitionBy("day").parquet(f"{tmp_path}/half")
    publish_partitions(spark, f"{tmp_path}/half", path)
    for _ in range(2):
        publish_partitions(spark, stage, path)
        assert {(r.name, r.day) for r in spark.read.parquet(path).collect()} == {("old", 0), ("new", 1), ("new", 2)}
    assert spark.read.parquet(path).count() == 6
    for day, names in files.items():
        moved = {n for n in file_names(spark, f"{path}/day={day}") if n.endswith(".parquet")}
        assert moved == {n for n in names if n.endswith(".parquet")}


def test_a_repair_neither_rewrites_staged_rows_nor_shuffles_kept_ones(spark, tmp_path, monkeypatch, rows_of):
    root, spec = str(tmp_path), m.SPECS["mat_clicks"]
    derived.click_facts(spark, SF).withColumn("batch_id", F.expr("IF(pmod(hash(click_id), 5) = 0, 2, 1)")).write.parquet(f"{root}/clicks")
    clicks = spark.read.parquet(f"{root}/clicks")
    tables = {d: derived.dimension(spark, SF, d) for d in ("dim_bidder", "dim_creative")}
    m.materialise(spark, spec, tables | {"clicks": clicks.filter("batch_id = 1")}, root)
    replaced, replace = [], m.replace_partitions
    monkeypatch.setattr(m, "replace_partitions", lambda df, path, by: (replaced.append(path), replace(df, path, by)))

    def stopped(spark, stage, path):
        raise RuntimeError("stopped")

    everything = tables | {"clicks": clicks}
    with monkeypatch.context() as patch:
        patch.setattr(m, "publish_partitions", stopped)
        with pytest.raises(RuntimeError):
            m.materialise(spark, spec, everything, root)
    m.materialise(spark, spec, everything, root)
    assert f"{root}/{spec.table}" not in replaced
    got = spark.read.parquet(f"{root}/{spec.table}").drop("event_date")
    assert rows_of(got) == rows_of(VIEWS[spec.view](everything).select(*got.columns))


def test_facts_of_a_view_are_those_it_reads(spark):
    dims = {d: derived.dimension(spark, SF, d) for d in DIMENSION_KEYS}
    for spec in m.SPECS.values():
        facts = {name: derived.FACTS[name](spark, SF) for name in m.facts_of(spec.view)}
        VIEWS[spec.view](dims | facts)  # no other fact is asked for


def shuffle_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ").count("/shuffle_")


def test_wide_rows_are_neither_shuffled_for_their_write_nor_marked_twice_and_shuffles_go(spark, tmp_path, monkeypatch, rows_of):
    spec, create = m.SPECS["mat_full_funnel"], m.create_table
    dims = {name: derived.dimension(spark, SF, name) for name, _ in spec.dims}
    facts = {}
    for name, build in derived.FACTS.items():
        rows = build(spark, SF)
        rows.withColumn("batch_id", F.expr(f"IF(pmod(hash({rows.columns[0]}), 7) = 0, 2, 1)")).write.parquet(f"{tmp_path}/{name}")
        facts[name] = spark.read.parquet(f"{tmp_path}/{name}")
    first = {name: rows.filter("batch_id = 1") for name, rows in facts.items()}
    for days, gathered in ((3, False), (2, True)):
        root, seen = f"{tmp_path}/{days}", []

        def watched(df, path, by=(), gather=True):
            if by:
                seen.append((gather, "_mark" in df._jdf.queryExecution().analyzed().toString()))
            create(df, path, by, gather)

        monkeypatch.setattr(m, "DIRECT_DAYS", days)
        monkeypatch.setattr(m, "create_table", watched)
        before = shuffle_files(spark)
        m.materialise(spark, spec, first | dims, root)
        m.materialise(spark, spec, facts | dims, root)
        for _ in range(50):  # files are removed in the background
            if shuffle_files(spark) <= before:
                break
            time.sleep(0.2)
        assert shuffle_files(spark) <= before
        assert seen == [(gathered, False)] * 2
        got = spark.read.parquet(f"{root}/{spec.table}").drop("event_date")
        assert rows_of(got) == rows_of(VIEWS[spec.view](facts | dims).select(*got.columns))
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
