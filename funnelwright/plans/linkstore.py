"""The links of the funnel stored by request, so that chain reports join them without an exchange.

A chain report follows request -> response -> impression -> click by a different id at
each hop, which shuffles every fact at every run. Here the hops are followed once, when
the links are stored: each response, impression and click goes beside the request that
its ids lead to, in buckets of the request. A report then joins bucket to bucket.

Links are distinct, so copies of events collapse. A request with very many links is
dealt over salts, as in ``left_join``, so no bucket has to hold it whole.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.functions import hour_of
from funnelwright.operators.funnel import STAGES, count_ids, stage_rates
from funnelwright.operators.joins import edges, hot_keys, named
from funnelwright.sources.tables import create_table

KEY = ["request_id", "salt"]
GROUP = ["hour_start", "publisher_id"]
_REQUESTS, _LINKS = "requests", "links"


def links_by_request(tables: Mapping[str, DataFrame]) -> DataFrame:
    """request_id, stage (1 to 3) and id of every event that the ids of its chain lead to a request."""
    answered = edges(tables["bid_responses"], "request_id", "response_id")
    won = answered.join(edges(tables["impressions"], "response_id", "impression_id"), "response_id").select(
        "request_id", "impression_id"
    )
    clicked = won.join(edges(tables["clicks"], "impression_id", "click_id"), "impression_id").select(
        "request_id", "click_id"
    )
    parts = [
        df.select("request_id", F.lit(stage).alias("stage"), F.col(df.columns[-1]).alias("id"))
        for stage, df in enumerate((answered, won, clicked), start=1)
    ]
    return reduce(DataFrame.unionByName, parts)


def store_links(
    tables: Mapping[str, DataFrame], spark: SparkSession, root: str, name: str, buckets: int, hot_rows: int | None = None
) -> None:
    """Write the links of flat tables to ``root`` and register them under ``name``; a full load into a new folder.

    Choose ``buckets`` so that one holds about as much as a task should read. Events
    without an id, and those whose chain reaches no response, are in no report and are
    left out; requests without a publisher or hour stay. Links to a request that is not
    there stay and match none.
    """
    found = f"{root}/found"
    create_table(links_by_request(tables), found)
    links = spark.read.parquet(found)
    create_table(hot_keys(links, "request_id", hot_rows), f"{root}/hot")
    hot = F.broadcast(spark.read.parquet(f"{root}/hot"))  # at most one key for HOT_ROWS links
    salts = F.coalesce("salts", F.lit(1))
    hour = hour_of(F.col("event_timestamp")).alias("hour_start")
    asked = named(tables["bid_requests"].select("request_id", hour, "publisher_id"), "request_id").distinct()
    asked = asked.join(hot, "request_id", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    dealt = links.join(hot, "request_id", "left").withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int"))
    for part, rows in ((_REQUESTS, asked.drop("salts")), (_LINKS, dealt.drop("salts"))):
        # One task writes one bucket, so a bucket is one sorted file.
        placed = rows.repartition(buckets, *KEY).distinct()
        writer = placed.write.bucketBy(buckets, *KEY).sortBy(*KEY).option("path", f"{root}/{part}")
        writer.format("parquet").saveAsTable(f"{name}_{part}")


def register_links(spark: SparkSession, root: str, name: str, buckets: int) -> None:
    """Make stored links known to a session whose catalog does not have them."""
    for part in (_REQUESTS, _LINKS):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{root}/{part}").schema)
        keys = ", ".join(KEY)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name}_{part} ({columns}) USING parquet LOCATION '{root}/{part}' "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS"
        )


def stored_funnel(spark: SparkSession, name: str) -> DataFrame:
    """Funnel by id links alone, per request hour and publisher, as ``linked_funnel`` counts it."""
    asked = spark.table(f"{name}_{_REQUESTS}")
    reached = spark.table(f"{name}_{_LINKS}").join(asked, KEY).select(*GROUP, "stage", "id")
    base = asked.select(*GROUP, F.lit(0).alias("stage"), F.col("request_id").alias("id"))
    return stage_rates(count_ids(base.unionByName(reached), GROUP, STAGES))
