"""The join shapes of the funnel: time-bounded joins and dimension look-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is hinted only when its estimate, which is of compressed files, is at
# most this large; rows in memory may take ten times as much.
BROADCAST_BYTES = 8 * 1024 * 1024

# A time bucket spans this many times the join interval, so about one row in
# sixteen of the right side is copied into a second bucket.
BUCKET_FACTOR = 16

# Keys with more rows than this on the right of a left join are hot.
HOT_ROWS = 10_000_000
# A row of an event fact takes at least so many bytes in a file, however compressed.
LEAST_ROW_BYTES = 4
# Sketches of a summary of frequent keys, values each tracks, keys it names at most.
SUMMARIES, TRACKED, NAMED = 64, 4096, 1000
# Parts a hot key is dealt over at most.
MOST_SALTS = 1024


def estimated_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, None where the session does not expose it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def sized_broadcast(df: DataFrame) -> DataFrame:
    """Hint a broadcast if the side is proven small, else leave the choice to AQE.

    Catalyst's estimate costs nothing. Where it is too high or missing (an
    aggregate is estimated at its input's size), AQE sees the true size of the
    side at run time and broadcasts it below its own threshold. No job runs
    while a plan is built.
    """
    size = estimated_bytes(df)
    return F.broadcast(df) if size is not None and size <= BROADCAST_BYTES else df


def dim_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[tuple[str, str]],
    columns: dict[str, str],
) -> DataFrame:
    """Left join to the current versions of a dimension.

    ``on`` pairs fact and dimension key columns; ``columns`` maps each output
    name to its dimension column. Facts without a match keep NULLs.
    """
    side = dim.filter("is_current").select(
        *[F.col(key).alias(f"_dim_{key}") for _, key in on],
        *[F.col(source).alias(name) for name, source in columns.items()],
    )
    condition = None
    for fact_key, dim_key in on:
        test = F.col(fact_key) == F.col(f"_dim_{dim_key}")
        condition = test if condition is None else condition & test
    return facts.join(sized_broadcast(side), condition, "left").drop(*[f"_dim_{key}" for _, key in on])


def named(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with all of these columns set, tested one by one.

    Joins infer the same tests. With them already there, a stage reads the same
    wherever it is used, and Spark runs its shuffle once for all uses.
    """
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def edges(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows with every column set.

    Copies of an event collapse map-side, before they can meet in a join.
    """
    return named(df.select(*columns), *columns).distinct()


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: int,
    upper: int,
    how: str = "inner",
) -> DataFrame:
    """Join on ``key`` where right_ts lies in [left_ts + lower, left_ts + upper] seconds.

    A coarse time bucket joins the equality keys: a left row has one bucket, a
    right row one or two. So rows of one hot key spread over many tasks, and
    only rows near each other in time are ever compared. Other columns of the
    two sides must not share names; ``key`` appears once in the result.
    """
    width = max(1, upper - lower) * BUCKET_FACTOR * 1_000_000

    def bucket(micros):
        # Never NULL, so that the join adds no test for it. A NULL time still
        # fails the interval test.
        return F.coalesce(micros - F.pmod(micros, F.lit(width).cast("long")), F.lit(0).cast("long"))

    at = F.unix_micros(right_ts)
    first, last = bucket(at - upper * 1_000_000), bucket(at - lower * 1_000_000)
    near = right.withColumn("_bucket", F.explode(F.sequence(first, last, F.lit(width).cast("long"))))
    here = left.withColumn("_bucket", bucket(F.unix_micros(left_ts)))

    near = near.withColumnsRenamed({key: "_right_key", "_bucket": "_right_bucket"})
    delta = F.unix_micros(right_ts) - F.unix_micros(left_ts)
    condition = (
        (here[key] == near["_right_key"])
        & (here["_bucket"] == near["_right_bucket"])
        & delta.between(lower * 1_000_000, upper * 1_000_000)
    )
    return here.join(near, condition, how).drop("_bucket", "_right_key", "_right_bucket")


def frequent_summary(df: DataFrame, key: str) -> DataFrame:
    """A mergeable summary of the most frequent values of ``key``: up to ``SUMMARIES`` sketches of fixed size.

    One scan, no shuffle of rows. A job that writes a table can write its summary
    beside it, one for each batch; summaries of batches are united, not counted again.
    """
    named_rows = df.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("_key"))
    part = F.pmod(F.spark_partition_id(), F.lit(SUMMARIES)).alias("part")
    return named_rows.groupBy(part).agg(F.expr(f"approx_top_k_accumulate(_key, {TRACKED})").alias("summary"))


def hot_keys(right: DataFrame, key: str, hot_rows: int | None = None, summary: DataFrame | None = None) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, and over how many ``salts`` to spread them. Lazy.

    With a summary of the side only the keys it names are counted. It names every
    key of more than about TRACKED / 4 times fewer rows than the side has. Without one, all are
    counted. Either way at most one key for so many rows: a short list.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    rows = right.filter(F.col(key).isNotNull())
    if summary is not None:
        merged = summary.agg(F.expr(f"approx_top_k_combine(summary, {TRACKED})").alias("all"))
        named_keys = merged.select(F.explode(F.expr(f"approx_top_k_estimate(all, {NAMED})")).alias("found"))
        named_keys = named_keys.select(F.col("found.item").cast(right.schema[key].dataType).alias(key))
        rows = rows.join(F.broadcast(named_keys), key, "left_semi")
    counts = rows.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") > hot_rows)
    salts = F.least(F.ceil(F.col("_rows") / hot_rows), F.lit(MOST_SALTS)).cast("int")
    return counts.select(key, salts.alias("salts"))


def may_be_hot(right: DataFrame, hot_rows: int | None = None) -> bool:
    """Whether a side can hold a hot key, by Catalyst's estimate of its size; costs no job."""
    size = estimated_bytes(right)
    return size is None or size >= (HOT_ROWS if hot_rows is None else hot_rows) * LEAST_ROW_BYTES


def left_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None = None) -> DataFrame:
    """Left join whose right side may hold very hot keys.

    Spark splits a skewed right side only in an inner join. The rows of ``hot`` keys
    (``hot_keys``) are dealt over salts on the right and copied to each salt on the
    left. A hot key has matches by definition, so the copies that find none are
    dropped, and all other rows are joined as they are, in one pass.
    """
    if hot is None:
        return left.join(right, key, "left")
    ours = F.broadcast(hot.select(F.col(key), F.col("salts").alias("_salts")))
    theirs = F.broadcast(hot.select(F.col(key), F.col("salts").alias("_their_salts")))
    copied = left.join(ours, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    salt = F.pmod(F.xxhash64(*right.columns), F.coalesce("_their_salts", F.lit(1))).cast("int")
    dealt = right.join(theirs, key, "left").withColumn("_salt", salt).drop("_their_salts").withColumn("_found", F.lit(True))
    joined = copied.join(dealt, [key, "_salt"], "left")
    columns = [*left.columns, *[c for c in right.columns if c != key]]
    return joined.filter(F.col("_salts").isNull() | F.col("_found")).select(*columns)
