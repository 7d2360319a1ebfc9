"""On which days the ids of facts occur, so that a repair by key reads those days and no others.

For each link column of a fact the index keeps (hash of id, day), about ten bytes
an event, in folders by slots of the hash. It grows by the batches that landed
since it was last extended, and tells through which batch it goes. Days of later
batches are read from the facts' own day column, so an index that lags names more
days, never fewer. Facts without a day or a batch column have none, and are read whole.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.operators.joins import sized_broadcast
from funnelwright.sources.tables import BATCH, path_exists, replace_partitions

Tables = Mapping[str, DataFrame]
DAY = "event_date"
INDEX = "key_index"
#: Folders that the hashes of one column are spread over; a look-up of few ids reads few.
SLOTS = 8

#: The id columns of each fact that repairs look up.
LINKS = {
    "bid_requests": ("request_id",),
    "bid_responses": ("response_id", "request_id"),
    "impressions": ("impression_id", "response_id", "request_id"),
    "clicks": ("click_id", "impression_id"),
}

_CHAIN = (
    ("bid_responses", "request_id", "bid_requests"),
    ("impressions", "response_id", "bid_responses"),
    ("clicks", "impression_id", "impressions"),
)
#: By view: the facts that it reaches from its driving fact, hop by hop, by which id, and from which fact.
HOPS = {
    "v_event_enriched_full_funnel": _CHAIN,
    "v_agg_funnel_by_publisher": _CHAIN,
    "v_agg_funnel_leakage": _CHAIN,
    "v_agg_serving_metrics": (("clicks", "impression_id", "impressions"),),
    "v_agg_bid_landscape": (("bid_requests", "request_id", "bid_responses"),),
    "v_agg_impressions_by_geo": (("bid_requests", "request_id", "impressions"),),
}


def _tracked(rows: DataFrame) -> bool:
    return DAY in rows.columns and BATCH in rows.columns


def _slotted(ids: Column) -> Column:
    """Slot and hash of an id."""
    id_hash = F.xxhash64(ids.cast("string"))
    return F.struct(F.pmod(id_hash, F.lit(SLOTS)).cast("int").alias("slot"), id_hash.alias("id_hash"))


def _path(root: str, fact: str) -> str:
    return f"{root}/{INDEX}/{fact}"


def covered(spark: SparkSession, root: str, fact: str) -> int | None:
    """The last batch that the index of a fact holds; None without an index."""
    path = f"{root}/{INDEX}/_through"
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema("fact string, through bigint").parquet(path).filter(F.col("fact") == fact)
    return rows.agg(F.max("through")).first()[0]


def extend_index(spark: SparkSession, tables: Tables, root: str) -> None:
    """Add the batches that landed since the last extension to the index of every tracked fact.

    Rows are written first, the mark after them; a run that stopped between is
    repeated by the next, which overwrites what it wrote for the same batches. Ids that
    are null join nothing and are left out; rows without a day are always read.
    """
    for fact, columns in LINKS.items():
        if fact not in tables or not _tracked(tables[fact]):
            continue
        rows, done = tables[fact], covered(spark, root, fact)
        batch = F.col(BATCH).cast("bigint")
        last = rows.agg(F.max(batch)).first()[0]
        if last is None or (done is not None and last <= done):
            continue
        new = rows.filter((batch > F.lit(-1 if done is None else done)) & (batch <= last) & F.col(DAY).isNotNull())
        entries = F.array(*[F.struct(F.lit(c).alias("link"), F.col(c).cast("string").alias("id")) for c in columns])
        entry = new.select(DAY, F.col(BATCH).cast("bigint").alias(BATCH), F.explode(entries).alias("entry"))
        entry = entry.filter("entry.id IS NOT NULL")
        at = entry.select("entry.link", _slotted(F.col("entry.id")).alias("at"), DAY, BATCH)
        held = at.select("link", "at.slot", "at.id_hash", DAY, BATCH).distinct()
        replace_partitions(held, _path(root, fact), ["link", "slot", BATCH])
        mark = spark.createDataFrame([(fact, last)], "fact string, through bigint")
        replace_partitions(mark, f"{root}/{INDEX}/_through", ["fact"])


def days_holding(spark: SparkSession, root: str, tables: Tables, fact: str, column: str, keys: DataFrame) -> DataFrame | None:
    """The days on which a row of the fact may hold one of the keys; None if the index cannot tell.

    ``keys`` has the ids in a column of the same name. Two ids of one hash name a day
    too many, which costs a read.
    """
    rows = tables[fact]
    through = covered(spark, root, fact) if _tracked(rows) and column in LINKS.get(fact, ()) else None
    if through is None:
        return None
    wanted = keys.select(_slotted(F.col(column)).alias("at")).select("at.*").distinct()
    held = spark.read.parquet(_path(root, fact)).filter(F.col("link") == column).select("slot", "id_hash", DAY)
    known = held.join(sized_broadcast(wanted), ["slot", "id_hash"], "left_semi").select(DAY)
    later = rows.filter(F.col(BATCH).cast("bigint") > through).select(DAY)
    return known.unionByName(later).filter(F.col(DAY).isNotNull()).distinct()


def on_days(rows: DataFrame, days: list) -> DataFrame:
    """Rows of these days, and those without one; only their folders are read."""
    return rows.filter(F.col(DAY).isNull() | F.col(DAY).isin(days))


def holding(spark: SparkSession, root: str, tables: Tables, fact: str, column: str, keys: DataFrame) -> DataFrame:
    """The fact on days that may hold one of the keys: all its rows that can join them, and few others."""
    days = days_holding(spark, root, tables, fact, column, keys)
    if days is None:
        return tables[fact]
    return on_days(tables[fact], [r[0] for r in days.collect()])  # a row for each day


def linked_sources(spark: SparkSession, root: str, view: str, sources: Tables) -> dict[str, DataFrame]:
    """The sources of a view, with each fact it reaches cut to the days that its links lead to.

    The ids of a hop are those of rows that the hop before it reached.
    """
    out = dict(sources)
    reached: dict[str, DataFrame] = {}
    for fact, column, origin in HOPS.get(view, ()):
        keys = reached.get(origin, out[origin]).select(column)
        days = days_holding(spark, root, sources, fact, column, keys)
        if days is None:
            break  # the next hops start at ids that are not known
        out[fact] = on_days(sources[fact], [r[0] for r in days.collect()])
        reached[fact] = out[fact].join(keys.distinct(), column, "left_semi")
    return out


def days_of_keys(spark: SparkSession, root: str, tables: Tables, fact: str, mark_keys: list) -> list | None:
    """Days of the driving fact that may hold a marked row; None if one of the marks can be on any day.

    A mark is an id that the index knows, or an hour, which names its day.
    """
    if not _tracked(tables[fact]):
        return None
    found = []
    for keys, on in mark_keys:
        if len(on) != 1:
            return None
        row, key = on[0]
        if key == "hour":
            days = keys.select(F.to_date("hour").alias(DAY)).filter(F.col(DAY).isNotNull())
        else:
            days = days_holding(spark, root, tables, fact, row, keys.select(F.col(key).alias(row)))
        if days is None:
            return None
        found.append(days)
    if not found:
        return []
    return [r[0] for r in reduce(DataFrame.unionByName, found).distinct().collect()]
