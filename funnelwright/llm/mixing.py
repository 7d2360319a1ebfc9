"""Mixing sources to target weights by pivotal dependent rounding.

Every document shall be taken a fractional number of times, its source's target over
its source's size. The whole part is taken; the fractions are rounded dependently.
Two documents at a time, one's fraction grows and the other's falls by equal numbers
of words, up to where one of both is whole, in one of the two directions by a coin
that leaves every expectation as it was. So what a source takes never moves, but for
the last open document. Documents are dealt into buckets of bounded size; each
bucket leaves one open document, and these are combined level by level in a tree. The very
last one of a source goes to the nearer whole number.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelwright.llm.common import WORDS, documents, stored, workers_import

#: A source's target is at most so many times its size.
MOST = 3
#: Documents of a bucket as expected, and open documents combined at once above.
BUCKET = 4096
FAN_IN = 256
SEED = 20240512
#: Fractions nearer to a whole number than this are whole.
CLOSE = 1e-9
#: Bytes of the sources' table up to which it is broadcast.
BROADCAST_BYTES = 8 * 1024 * 1024
#: Copies of one row that a task writes out at once.
AT_ONCE = 10_000


def one_two_three(rank: Column) -> Column:
    """Weights 1, 2, 3, 1, ... by rank from 0."""
    return 1 + F.pmod(rank, F.lit(3))


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words, null text: 0) and ``rows``, how many rows are alike in these."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORDS)), F.lit(0)).cast("bigint")
    return (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string"), size.alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count("*").alias("rows"))
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` from 0 by code point, null last: numbers within ranges, and rows of the ranges before."""
    dealt = sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id())
    dealt = stored(dealt, "sources-dealt")
    parts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))  # a row a partition
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last()))
    return (
        dealt.join(F.broadcast(parts.select("_part", before.alias("_before"))), "_part")
        .withColumn("rank", within - 1 + F.col("_before"))
        .drop("_part", "_before")
    )


def targets(sized: DataFrame, weight: Callable[[Column], Column] = one_two_three, most: int = MOST) -> DataFrame:
    """``source``, ``rank``, ``source_size``, ``documents``, ``weight`` and ``target`` of every source.

    Targets share the sum of all sizes by weight, but stop at ``most`` times their
    source's size; what that leaves is shared by weight again until none is above.
    Each round is one sum over the sources, and the share of a unit weight only rises.
    """
    sums = sized.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("documents")
    )
    ranked = _ranked(sums)
    ranked = stored(ranked.withColumn("weight", weight(F.col("rank"))), "sources")
    cap = most * F.col("source_size")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    unit = -1.0
    while True:
        stops = cap <= unit * F.col("weight")
        held, open_ = ranked.agg(F.sum(F.when(stops, cap)), F.sum(F.when(~stops, F.col("weight")))).first()
        if not open_:
            unit = float("inf")
            break
        before, unit = unit, (total - (held or 0)) / open_
        if unit <= before:
            break
    share = unit * F.col("weight") if np.isfinite(unit) else cap
    return ranked.withColumn("target", F.least(cap.cast("double"), share.cast("double")))


def pivot(fraction: np.ndarray, size: np.ndarray, coins: np.ndarray) -> tuple[np.ndarray, int]:
    """Round fractions in order, two at a time: 0 or 1 for each, and the place of the one left open (-1: none).

    The sum of fraction times size stays, but for rounding in doubles, and so does
    the expectation of each fraction.
    """
    out = fraction.copy()
    open_ = -1
    for k in range(len(out)):
        if out[k] <= CLOSE or out[k] >= 1 - CLOSE:
            out[k] = round(out[k])
            continue
        if open_ < 0:
            open_ = k
            continue
        i, j = open_, k
        up = min((1 - out[i]) * size[i], out[j] * size[j])  # words that may go from j to i
        down = min(out[i] * size[i], (1 - out[j]) * size[j])
        moved = up if coins[k] * (up + down) < down else -down
        out[i] += moved / size[i]
        out[j] -= moved / size[j]
        for m in (i, j):
            if out[m] <= CLOSE or out[m] >= 1 - CLOSE:
                out[m] = round(out[m])
        open_ = next((m for m in (i, j) if 0 < out[m] < 1), -1)
    return out, open_


_DEALT = "rank bigint, node bigint, nodes bigint, doc_id bigint, size bigint, rows bigint, whole bigint, fraction double"


def _combine(level: int) -> Callable[[pa.Table], pa.Table]:
    """Round the open documents of one bucket; the last one is left open unless the bucket is the root."""

    def combine(group: pa.Table) -> pa.Table:
        group = group.take(pc.sort_indices(group, [("size", "descending"), ("doc_id", "ascending"), ("rows", "ascending")]))
        rank, node, nodes = (group.column(c)[0].as_py() for c in ("rank", "node", "nodes"))
        coins = np.random.default_rng([SEED, level, rank, node]).random(len(group))
        out, open_ = pivot(group.column("fraction").to_numpy(), group.column("size").to_numpy(), coins)
        if open_ >= 0 and nodes == 1:
            out[open_] = round(out[open_])
        return group.set_column(group.schema.get_field_index("fraction"), "fraction", pa.array(out))

    return combine


def rounded(open_: DataFrame) -> DataFrame:
    """Every open document with its fraction made 0 or 1; columns of ``_DEALT``.

    ``nodes`` says how many buckets a source has at a level, ``node`` which one a
    document is in. Each level is stored, so a lost executor repeats buckets only.
    """
    done, level = [], 0
    while True:
        made = stored(open_.groupBy("rank", "node").applyInArrow(_combine(level), _DEALT), f"level-{level}")
        whole = F.col("fraction").isin(0.0, 1.0)
        done.append(made.filter(whole))
        open_ = made.filter(~whole)
        if open_.isEmpty():
            break
        level += 1
        open_ = open_.withColumns(
            {"node": F.floor(F.col("node") / FAN_IN), "nodes": F.ceil(F.col("nodes") / FAN_IN)}
        )
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _each_row(groups: DataFrame) -> DataFrame:
    """Write out the rows that were alike; the first ``extra`` of them are taken once more.

    A group of very many is cut into pieces that are dealt anew first.
    """
    single = groups.filter("rows = 1").withColumn("copies", F.col("whole") + F.col("extra"))
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rows") - 1, F.lit(AT_ONCE).cast("bigint")))
    pieces = groups.filter("rows > 1").withColumn("start", start).hint("rebalance")
    last = F.least(F.col("start") + AT_ONCE, F.col("rows")) - 1
    many = pieces.withColumn("number", F.explode(F.sequence("start", last))).withColumn(
        "copies", F.col("whole") + (F.col("number") < F.col("extra")).cast("bigint")
    )
    return single.unionByName(many.drop("start", "number"))


def mix(docs: DataFrame, weight: Callable[[Column], Column] = one_two_three, most: int = MOST) -> DataFrame:
    """``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``taken`` of every row.

    A source takes its target's words to within half of one document. No row is taken more
    than ``most`` times. Rows alike in id, source and size share one fraction:
    all but one of them are settled by the sum. Rows without words are taken the
    whole number of times, to no effect. Null sources are one source, the last; null
    ids are dealt as one id. Coins follow from ids, sources and sizes, not from how
    the rows are stored, so reruns agree. Other columns are not read; an empty
    table gives none.
    """
    spark = docs.sparkSession
    workers_import(spark)
    sized = stored(sizes(docs), "sized")
    found = stored(targets(sized, weight, most), "targets")
    bytes_ = found.agg(F.sum(64 + F.coalesce(F.octet_length("source"), F.lit(0)))).first()[0] or 0
    sources = F.broadcast(found) if bytes_ <= BROADCAST_BYTES else found

    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    placed = sized.withColumnRenamed("source", "_source").join(
        sources, F.col("_source").eqNullSafe(F.col("source")), "inner"
    )
    nodes = F.ceil(F.col("documents") / BUCKET)
    share = F.col("rows") * (F.col("ratio") - F.col("whole"))
    placed = (
        placed.withColumn("ratio", ratio)
        .withColumn("whole", F.floor(F.col("ratio") + CLOSE))
        .withColumn("share", F.greatest(share, F.lit(0.0)))
        .withColumn("extra", F.floor(F.col("share") + CLOSE))
        .withColumn("fraction", F.greatest(F.col("share") - F.col("extra"), F.lit(0.0)))
        .withColumn("nodes", nodes)
        .withColumn("node", F.pmod(F.xxhash64("doc_id", "size"), nodes))
    )
    is_open = (F.col("fraction") > CLOSE) & (F.col("size") > 0)
    # ``whole`` of a group in the tree is what all its rows get more for sure
    dealt = placed.filter(is_open).select(
        "rank", "node", "nodes", "doc_id", "size", "rows", F.col("extra").alias("whole"), "fraction"
    )
    settled = placed.filter(~is_open).select("rank", "doc_id", "size", "rows", "extra")
    up = rounded(dealt).select(
        "rank", "doc_id", "size", "rows", (F.col("whole") + F.col("fraction").cast("bigint")).alias("extra")
    )
    judged = settled.unionByName(up).join(sources.drop("documents", "weight"), "rank")
    judged = judged.withColumn("whole", F.floor(ratio + CLOSE))
    return _each_row(judged).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
