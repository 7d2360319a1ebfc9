"""Shards by extendible hashing, with built-in functions only.

A document's hash is a string of bits. A bucket is a prefix of it; a bucket
over the byte limit splits on its next bit, all others stay, until every shard
fits. Whether a bucket splits depends only on the bytes below its prefix, so a
few aggregations over (prefix, bytes) give the same directory as inserting
documents one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import documents, stored

LIMIT_BYTES = 2 * 1024 * 1024
#: Bits decided in one pass: a bucket over the limit has 256 cells below it.
STEP = 8
#: Cells are broadcast up to so many rows (under 100 bytes each).
BROADCAST_CELLS = 100_000


def _bits(hex_pair: Column) -> Column:
    return F.lpad(F.conv(hex_pair, 16, 2), 8, "0")


def _sized(docs: DataFrame, key: str) -> DataFrame:
    """Key, content and row hashes in hex, and bytes.

    The key alone decides the first 128 bits, so a key's shard can be found
    without its text. Rows of one key split on their texts, and rows that are
    equal in both on their place in the input.
    """
    text = F.coalesce("text", F.lit(""))
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return docs.select(
        key,
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.concat(F.md5(name), F.md5(text), F.md5(F.monotonically_increasing_id().cast("string"))).alias("_hash"),
    )


def _cells(rows: DataFrame, at: int) -> DataFrame:
    pair = F.substring("_hash", at * STEP // 4 + 1, 2)
    return rows.withColumn("_cell", _bits(pair))


def assign(docs: DataFrame, key: str = "doc_id", limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """``key``, ``n_bytes`` and ``shard`` (the bits of its prefix) of every row.

    Null keys share the hash of the word null, null texts are empty. Repeated
    keys and repeated rows are split like others, on later bits. A shard is over
    the limit only if it holds a single document; ``oversized`` says so. An
    empty table has no shards. Other columns are ignored.
    """
    rows = stored(_sized(docs, key), "sizes").withColumn("shard", F.lit(""))
    done = []
    for at in range(3 * 128 // STEP):
        rows = _cells(rows, at)
        cells = stored(rows.groupBy("shard", "_cell").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "cells")
        lengths = F.sequence(F.lit(0 if at == 0 else 1), F.lit(STEP))
        buckets = (
            cells.select("shard", F.explode(lengths).alias("len"), "_cell", "b", "n")
            .groupBy("shard", F.expr("left(_cell, len)").alias("prefix"))
            .agg(F.sum("b").alias("b"), F.sum("n").alias("n"))
            .withColumn("fits", (F.col("b") <= limit_bytes) | (F.col("n") == 1))
        )
        fitting = buckets.filter("fits").select("shard", "prefix", "b", "n")
        above = fitting.select("shard", F.col("prefix").alias("parent"))
        leaves = fitting.join(
            above,
            (fitting["shard"] == above["shard"])
            & (F.length(fitting["prefix"]) > 0)
            & (F.expr("left(prefix, length(prefix) - 1)") == above["parent"]),
            "left_anti",
        )
        placed = (
            cells.select("shard", "_cell", F.explode(lengths).alias("len"))
            .withColumn("prefix", F.expr("left(_cell, len)"))
            .join(leaves, ["shard", "prefix"])
            .select("shard", "_cell", "prefix", (F.col("b") > limit_bytes).alias("oversized"))
        )
        placed = stored(placed, "placed")
        if cells.count() <= BROADCAST_CELLS:
            placed = F.broadcast(placed)
        rows = rows.join(placed, ["shard", "_cell"], "left")
        done.append(
            rows.filter("prefix IS NOT NULL").select(
                key, "n_bytes", F.concat("shard", "prefix").alias("shard"), "oversized"
            )
        )
        if at and at % 2 == 0:
            rows = stored(rows, "rows")
        open_ = cells.join(placed, ["shard", "_cell"], "left_anti")
        if open_.isEmpty():
            break
        rows = rows.filter("prefix IS NULL").select(
            key, "n_bytes", "_hash", F.concat("shard", "_cell").alias("shard")
        )
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def directory(assigned: DataFrame) -> DataFrame:
    """The directory: every prefix of the greatest depth in use, and the shard it points to.

    Bounded by two to that depth; ``entry`` is the index, ``shard`` the prefix.
    """
    shards = assigned.groupBy("shard").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_docs"))
    shards = shards.withColumn("depth", F.length("shard"))
    depth = shards.agg(F.max("depth")).first()[0] or 0
    start = F.conv(F.rpad(F.concat(F.lit("0"), "shard"), depth + 1, "0"), 2, 10).cast("bigint")
    size = F.expr(f"shiftleft(1L, {depth} - depth)")
    return shards.withColumn("entry", F.explode(F.sequence(start, start + size - 1)))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign(documents(spark, sf_dir)).select(
        "doc_id", "n_bytes", "shard", F.length("shard").cast("long").alias("depth"), "oversized"
    )


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0) AS n_bytes,
         (SELECT string_agg(CASE c WHEN '0' THEN '0000' WHEN '1' THEN '0001' WHEN '2' THEN '0010' WHEN '3' THEN '0011'
            WHEN '4' THEN '0100' WHEN '5' THEN '0101' WHEN '6' THEN '0110' WHEN '7' THEN '0111' WHEN '8' THEN '1000'
            WHEN '9' THEN '1001' WHEN 'a' THEN '1010' WHEN 'b' THEN '1011' WHEN 'c' THEN '1100' WHEN 'd' THEN '1101'
            WHEN 'e' THEN '1110' ELSE '1111' END, '' ORDER BY i)
          FROM (SELECT i, substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null')), CAST(i AS INT), 1) AS c
                FROM range(1, 17) t(i))) AS bits
  FROM documents
), buckets AS (
  SELECT left(bits, CAST(depth AS INT)) AS prefix, depth, sum(n_bytes) AS b, count(*) AS n
  FROM d, range(0, 64) t(depth) GROUP BY 1, 2
), leaf AS (
  SELECT doc_id, n_bytes, min(depth) AS depth, any_value(bits) AS bits
  FROM d JOIN buckets ON buckets.prefix = left(d.bits, CAST(buckets.depth AS INT))
  WHERE b <= {LIMIT_BYTES} OR n = 1 GROUP BY doc_id, n_bytes
)
SELECT doc_id, n_bytes, left(bits, CAST(depth AS INT)) AS shard, depth, n_bytes > {LIMIT_BYTES} AS oversized
FROM leaf
"""
