"""Parquet tables: reading, replacing partitions, compaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.model import FACT_PARTITIONS, conform, table_schema

TARGET_FILE_BYTES = 128 * 1024 * 1024


def _hadoop_path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _hadoop_path(spark, path)
    return bool(files.exists(target))


def path_bytes(spark: SparkSession, path: str) -> int:
    files, target = _hadoop_path(spark, path)
    return int(files.getContentSummary(target).getLength())


def table_exists(spark: SparkSession, root: str, table: str) -> bool:
    return path_exists(spark, f"{root}/{table}")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table under its contract; without one, under the schema of its files.

    Of a table that has been compacted, the rows that the newest marker shows: merged
    ones where a day has been merged, and the batches after those.
    """
    try:
        contract = table_schema(table)
    except KeyError:
        contract = None

    def read(path: str) -> DataFrame:
        return (spark.read.schema(contract) if contract else spark.read).parquet(path)

    marks = _marks(spark, root, table)
    if not marks:
        return read(f"{root}/{table}")
    merged = read(_merged(root, table))
    unmerged = spark.read.schema(merged.drop(RUN).schema).parquet(f"{root}/{table}")
    return _shown(merged, RUN, marks, "run", "=").drop(RUN).unionByName(_shown(unmerged, BATCH, marks, "through", ">"))


def with_event_date(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return df.withColumn("event_date", F.to_date(ts))


def time_range(df: DataFrame, lo, hi, ts: str = "event_timestamp") -> DataFrame:
    """Rows with lo <= ts <= hi; also filters the day column so that partitions are pruned."""
    out = df.filter(F.col(ts).between(F.lit(lo), F.lit(hi)))
    if "event_date" in df.columns:
        out = out.filter(F.col("event_date").between(F.to_date(F.lit(lo)), F.to_date(F.lit(hi))))
    return out


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of a partition together before a write.

    Few files per partition, while AQE splits a partition too large for one
    task, so a hot value is still written by many.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Overwrite exactly the partitions present in ``df``.

    Writing the same rows again leaves the table as it was, which makes
    retries after a lost executor or driver safe.
    """
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append_facts(df: DataFrame, root: str, table: str) -> None:
    """Append to a fact table, partitioned by day and its second column."""
    second = FACT_PARTITIONS[table]
    columns = ["event_date"] + ([second] if second else [])
    rows = balanced(with_event_date(conform(df, table)), columns)
    rows.write.mode("append").partitionBy(*columns).parquet(f"{root}/{table}")


def create_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), gather: bool = True) -> None:
    """Full load: the table holds the rows of ``df`` and nothing else.

    Without ``gather`` no row is shuffled for the write: each task writes a file to every partition it has rows of.
    """
    rows = balanced(df, partition_by) if partition_by and gather else df
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def publish_partitions(spark: SparkSession, stage: str, path: str) -> None:
    """Put the partitions of a staged table in place of those of the table, by moving their folders.

    No row is read or shuffled again. What has been moved is no longer in the stage, so
    a run that stopped on the way is finished by calling this again.
    """
    for folder in subfolders(spark, stage):
        if "=" in folder:
            delete_path(spark, f"{path}/{folder}")
            move_path(spark, f"{stage}/{folder}", f"{path}/{folder}")
    spark.catalog.refreshByPath(path)


BATCH = "batch_id"
RUN = "compaction_run"


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of a stored table in the order of its folders."""
    files = spark.read.parquet(path).inputFiles()
    inside = files[0].split(path.rstrip("/").rsplit("/", 1)[-1] + "/", 1)[1] if files else ""
    return [part.split("=", 1)[0] for part in inside.split("/")[:-1] if "=" in part]


def _merged(root: str, table: str) -> str:
    return f"{root}/_merged/{table}"


def _runs(spark: SparkSession, root: str, table: str) -> list[int]:
    """Numbers of the runs of compaction that published a marker."""
    path = f"{root}/_compacted/{table}"
    names = subfolders(spark, path) if path_exists(spark, path) else []
    return sorted(int(n.split("=")[1]) for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def _marks(spark: SparkSession, root: str, table: str) -> list:
    """What the newest marker says: for each merged day the run that merged it, and its last merged batch."""
    runs = _runs(spark, root, table)
    if not runs:
        return []
    return spark.read.parquet(f"{root}/_compacted/{table}/run={runs[-1]}").orderBy("day").collect()


def _shown(rows: DataFrame, column: str, marks: list, field: str, sign: str) -> DataFrame:
    """Rows whose ``column`` is after (>) or equals (=) the mark of their day; prunes partitions."""
    pairs = [F.lit(v) for m in marks for v in (m["day"], m[field])]
    mark = F.create_map(*pairs)[F.col(marks[0]["day_column"]).cast("string")]
    value = F.col(column).cast("bigint")
    return rows.filter(value > F.coalesce(mark, F.lit(-1)) if sign == ">" else value == mark)


def compacted_through(spark: SparkSession, root: str, table: str) -> int:
    """The last batch that compaction has closed; -1 if none. A retry of such a batch must not land again."""
    return max((m["closed"] for m in _marks(spark, root, table)), default=-1)


def compact(spark: SparkSession, path: str, partition: dict[str, str], before_batch: int | None = None) -> int:
    """Rewrite one partition into fewer files of about 128 MB; returns how many files were planned.

    In a table that tells batches, ``partition`` names a day, and its rows of batches
    before ``before_batch`` are merged, all other partition columns kept, beside the
    table. Then one marker shows them in place of those batches, which readers by
    ``read_table`` see from one moment to the next: never twice, never not at all. The
    ingest skips a retry of a closed batch. What a marker has replaced stays for readers
    under way, until ``remove_replaced``. A run that stopped before its marker has
    changed nothing. One run at a time.

    Another table's partition is overwritten, which readers should not be reading.
    Rows go to files round robin, so a hot key does not make one large file.
    """
    root, table = path.rstrip("/").rsplit("/", 1)
    names = partition_columns(spark, path)
    folder = path + "".join(f"/{name}={value}" for name, value in partition.items())
    files = max(1, -(-path_bytes(spark, folder) // TARGET_FILE_BYTES)) if path_exists(spark, folder) else 1
    rows = read_table(spark, root, table) if BATCH in names else spark.read.parquet(path)
    for name, value in partition.items():
        rows = rows.filter(F.col(name) == F.lit(value))
    if BATCH not in names:
        stage = f"{root}/_compacting/{table}"
        rows = rows.repartition(files) if names == list(partition) else balanced(rows, names)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*names).parquet(stage)
        replace_partitions(spark.read.parquet(stage), path, names)
        delete_path(spark, stage)
        return files
    if before_batch is None:
        raise ValueError("name the first batch that may still be retried")
    if list(partition) != names[:1]:
        raise ValueError(f"batches are merged by {names[0]}")
    rows = rows.filter(F.col(BATCH) < before_batch)
    last = rows.agg(F.max(BATCH)).first()[0]
    if last is None:
        return 0
    marks = _marks(spark, root, table)
    run = 1 + max(_runs(spark, root, table), default=-1)
    rows = rows.withColumn(BATCH, F.lit(last))
    rows = rows.repartition(files) if len(names) == 2 else balanced(rows, names)
    target = f"{_merged(root, table)}/{RUN}={run}"
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*names).parquet(target)
    closed = max(before_batch - 1, *[m["closed"] for m in marks], -1)
    day = str(next(iter(partition.values())))
    kept = [(m["day"], m["run"], m["through"]) for m in marks if m["day"] != day]
    shown = [(names[0], *m, closed) for m in [*kept, (day, run, before_batch - 1)]]
    marker = spark.createDataFrame(shown, "day_column string, day string, run bigint, through bigint, closed bigint")
    marker.coalesce(1).write.mode("overwrite").parquet(f"{root}/_compacted/{table}/run={run}")
    return files


def remove_replaced(spark: SparkSession, path: str) -> None:
    """Remove the batches and runs that the newest marker has replaced, once nobody reads them any more."""
    root, table = path.rstrip("/").rsplit("/", 1)
    marks, runs = _marks(spark, root, table), _runs(spark, root, table)
    for mark in marks:
        _remove_batches(spark, f"{path}/{mark['day_column']}={mark['day']}", mark["through"])
    shown = {m["run"] for m in marks}
    for run in runs:
        if run not in shown:
            delete_path(spark, f"{_merged(root, table)}/{RUN}={run}")
        if run != runs[-1]:
            delete_path(spark, f"{root}/_compacted/{table}/run={run}")


def _remove_batches(spark: SparkSession, folder: str, through: int) -> None:
    for name in subfolders(spark, folder) if path_exists(spark, folder) else []:
        if not name.startswith(f"{BATCH}="):
            _remove_batches(spark, f"{folder}/{name}", through)
        elif int(name.split("=")[1]) <= through:
            delete_path(spark, f"{folder}/{name}")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    files, target = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory()]


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder, none if it does not exist."""
    files, target = _hadoop_path(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target) if s.isFile()] if files.exists(target) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder this library wrote."""
    files, target = _hadoop_path(spark, path)
    files.delete(target, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    """Move a file or folder this library wrote to a place that is free, on the same file system."""
    files, source = _hadoop_path(spark, path)
    place = _hadoop_path(spark, target)[1]
    files.mkdirs(place.getParent())
    if not files.rename(source, place):
        raise OSError(f"could not move {path} to {target}")
