"""Slowly changing dimensions: load, current and as-of versions, hierarchy paths."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelwright.model import DIMENSION_KEYS, conform
from funnelwright.operators.joins import BROADCAST_BYTES, estimated_bytes, sized_broadcast
from funnelwright.sources.tables import create_table, delete_path, path_exists, read_table, table_exists


LOADED = "_load"


def load_dimension(spark: SparkSession, rows: DataFrame, table: str, root: str) -> DataFrame:
    """Bring the stored versions up to date with a load; loading the same rows again changes nothing.

    Of one key and start of validity the newest load counts, so a version can be
    closed or retired later. The table is staged in full before it is replaced,
    and an interrupted load publishes its stage first.
    """
    key, path, stage = DIMENSION_KEYS[table], f"{root}/{table}", f"{root}/_staging/{table}"
    if path_exists(spark, f"{stage}/_SUCCESS"):
        create_table(spark.read.parquet(stage), path)
    fresh = conform(rows, table)
    known = read_table(spark, root, table) if table_exists(spark, root, table) else fresh.limit(0)
    create_table(restated(known, fresh, key), stage)
    create_table(read_table(spark, f"{root}/_staging", table), path)
    delete_path(spark, stage)
    return read_table(spark, root, table)


def restated(known: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Stored and loaded versions, the loaded one where both have it, with validity restated.

    A version ends where the key's next one starts. The last one of a key stays
    current unless it is explicitly closed or retired.
    """
    columns = known.columns
    both = known.withColumn(LOADED, F.lit(0)).unionByName(fresh.select(*columns).withColumn(LOADED, F.lit(1)))
    # Rows that a load repeats are ordered by content, so that a retry picks the same one.
    newest = Window.partitionBy(key, "valid_from").orderBy(
        F.desc(LOADED), F.col("valid_to").desc_nulls_last(), F.xxhash64(*columns)
    )
    versions = both.withColumn("_row", F.row_number().over(newest)).filter("_row = 1").drop("_row", LOADED)
    following = F.lead("valid_from").over(Window.partitionBy(key).orderBy("valid_from"))
    return (
        versions.withColumn("_next", following)
        .withColumn("is_current", F.coalesce("is_current", F.lit(True)) & F.col("_next").isNull())
        .withColumn("valid_to", F.coalesce("_next", "valid_to"))
        .drop("_next")
        .select(*columns)
    )


def current_version(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def apply_changes(dim: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Add new versions and restate each key's validity; a retired key stays retired."""
    return restated(dim, changes, key)


#: Facts of one key are put in order within spans of so many seconds.
SPAN_SECONDS = 86_400


def as_of_join(facts: DataFrame, dim: DataFrame, key: str, ts: str, columns: dict[str, str]) -> DataFrame:
    """Left join to the version valid at each fact's time.

    Of a key's versions that started by then the last one counts, if it has not
    ended; of two that start together the one that ends last. A version without a
    start, or of no key, is never valid; facts without a key or a time keep NULLs.
    No fact is ever paired with all versions of its key: a dimension that is proven
    small is brought to the facts as one row a key, any other is merged with them
    in the order of time.
    """
    versions = dim.filter(F.col(key).isNotNull() & F.col("valid_from").isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("valid_from").alias("_from"),
        F.struct(
            F.col("valid_to").alias("_to"), *[F.col(source).alias(name) for name, source in columns.items()]
        ).alias("_version"),
    )
    size = estimated_bytes(dim)
    small = size is not None and size <= BROADCAST_BYTES
    found = _looked_up(facts, versions, key, ts) if small else _merged(facts, versions, key, ts)
    valid = F.col("_version._to").isNull() | (F.col(ts) < F.col("_version._to"))
    return found.select(
        *facts.columns, *[F.when(valid, F.col(f"_version.{name}")).alias(name) for name in columns]
    )


def _ends_last(version: str):
    """For ordering: open versions end after all others."""
    return F.coalesce(F.col(f"{version}._to"), F.lit("9999-12-31").cast("timestamp"))


def _looked_up(facts: DataFrame, versions: DataFrame, key: str, ts: str) -> DataFrame:
    """Add ``_version`` by a broadcast list of versions for each key, in the order of their starts."""
    entry = F.struct("_from", _ends_last("_version").alias("_end"), "_version")
    lists = versions.groupBy("_key").agg(F.array_sort(F.collect_list(entry)).alias("_versions"))
    begun = F.filter("_versions", lambda v: v["_from"] <= F.col(ts))
    joined = facts.join(F.broadcast(lists), facts[key] == F.col("_key"), "left")
    return joined.withColumn("_version", F.try_element_at(begun, F.lit(-1))["_version"])


def _merged(facts: DataFrame, versions: DataFrame, key: str, ts: str) -> DataFrame:
    """Add ``_version`` by carrying the last one along the facts, in spans of time.

    Each span of a key is put in order by a task of its own, so a hot key is spread.
    What a span starts with is found from the versions and one row a span.
    """

    def span(at):
        micros = F.unix_micros(at)
        return micros - F.pmod(micros, F.lit(SPAN_SECONDS * 1_000_000).cast("long"))

    timed = F.col(key).isNotNull() & F.col(ts).isNotNull()
    rows = facts.filter(timed).select(
        F.col(key).alias("_key"), span(F.col(ts)).alias("_span"), F.col(ts).alias("_at"), F.struct(*facts.columns).alias("_fact")
    )
    starts = versions.select(
        "_key", span(F.col("_from")).alias("_span"), F.col("_from").alias("_at"), "_version", _ends_last("_version").alias("_end")
    )
    spans = rows.select("_key", "_span").distinct()
    begins = spans.withColumn("_at", F.timestamp_micros("_span"))
    order = [F.col("_at"), F.col("_end").asc_nulls_last()]  # versions come before what starts at the same time
    so_far = Window.partitionBy("_key").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = (
        starts.unionByName(begins, allowMissingColumns=True)
        .withColumn("_last", F.last("_version", ignorenulls=True).over(so_far))
        .filter(F.col("_version").isNull() & F.col("_last").isNotNull())
        .select("_key", "_span", "_at", F.col("_last").alias("_version"), F.timestamp_micros(F.lit(0).cast("long")).alias("_end"))
    )
    within = Window.partitionBy("_key", "_span").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # versions of spans without facts end with the carrying
    near = starts.join(spans, ["_key", "_span"], "left_semi")
    merged = near.unionByName(carried).unionByName(rows, allowMissingColumns=True)
    found = (
        merged.withColumn("_version", F.last("_version", ignorenulls=True).over(within))
        .filter(F.col("_fact").isNotNull())
        .select("_fact.*", "_version")
    )
    untimed = facts.filter(~timed).withColumn("_version", F.lit(None).cast(versions.schema["_version"].dataType))
    return found.unionByName(untimed)


def creative_path(
    creatives: DataFrame, strategies: DataFrame, line_items: DataFrame, campaigns: DataFrame, advertisers: DataFrame
) -> DataFrame:
    """The buy-side path of every creative, up to its agency."""
    hops = [
        (strategies, "strategy_id", "line_item_id"),
        (line_items, "line_item_id", "campaign_id"),
        (campaigns, "campaign_id", "advertiser_id"),
        (advertisers, "advertiser_id", "agency_id"),
    ]
    path = current_version(creatives).select("creative_id", "strategy_id")
    for dim, key, parent in hops:
        path = path.join(sized_broadcast(current_version(dim).select(key, parent)), key)
    return path.select("creative_id", "strategy_id", "line_item_id", "campaign_id", "advertiser_id", "agency_id")
