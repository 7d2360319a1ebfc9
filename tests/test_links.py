"""Links stored by request: equal to the joined facts, without an exchange below the join."""

import re

from pyspark.sql import functions as F

from funnelwright.operators.funnel import linked_funnel
from funnelwright.plans.linkstore import register_links, store_links, stored_funnel
from funnelwright.sources import derived

SF = "/root/testdata/sf0.001"
STAGES = ("bid_requests", "bid_responses", "impressions", "clicks")


def _joined(facts):
    return linked_funnel(*[facts[t] for t in STAGES])


def _plan(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_join_without_exchange(spark, tmp_path, rows_of):
    facts = {t: derived.FACTS[t](spark, SF) for t in STAGES}
    store_links(facts, spark, str(tmp_path), "links_plain", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        funnel = stored_funnel(spark, "links_plain")
        assert rows_of(funnel) == rows_of(_joined(facts))
        plan = _plan(funnel)
        at = plan.index("SortMergeJoin")
        assert "Exchange" not in plan[at:] and plan.count("Bucketed: true") >= 2
        # an exchange that deals links by their request, anywhere, would show the key
        assert not re.search(r"hashpartitioning\(request_id", plan)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for part in ("requests", "links"):
        assert len(list((tmp_path / part).glob("*.parquet"))) <= 4


def test_hot_request_is_dealt_over_salts(spark, tmp_path, rows_of):
    """One request with a third of all responses, copies of events, and missing ids."""
    facts = {t: derived.FACTS[t](spark, SF) for t in STAGES}
    hot = facts["bid_requests"].agg(F.min("request_id")).first()[0]
    moved = F.when(F.pmod(F.hash("response_id"), F.lit(3)) == 0, F.lit(hot)).otherwise(F.col("request_id"))
    facts["bid_responses"] = facts["bid_responses"].withColumn("request_id", moved)
    facts["clicks"] = facts["clicks"].unionByName(facts["clicks"])
    facts["impressions"] = facts["impressions"].unionByName(
        facts["impressions"].limit(5).withColumn("response_id", F.lit(None).cast("string"))
    )
    store_links(facts, spark, str(tmp_path), "links_hot", 8, hot_rows=50)
    links = spark.table("links_hot_links")
    assert links.filter(F.col("request_id") == hot).select("salt").distinct().count() > 4
    assert rows_of(stored_funnel(spark, "links_hot")) == rows_of(_joined(facts))


def test_empty_tables_and_a_new_catalog(spark, tmp_path, rows_of):
    facts = {t: derived.FACTS[t](spark, SF) for t in STAGES}
    store_links(facts, spark, str(tmp_path / "a"), "links_old", 4)
    register_links(spark, str(tmp_path / "a"), "links_again", 4)
    assert rows_of(stored_funnel(spark, "links_again")) == rows_of(stored_funnel(spark, "links_old"))
    none = {t: rows.limit(0) for t, rows in facts.items()}
    store_links(none, spark, str(tmp_path / "b"), "links_none", 4)
    assert stored_funnel(spark, "links_none").count() == 0
