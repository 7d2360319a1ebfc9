"""Session settings the operators rely on, and where jobs may write."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings. All of them can be changed on a running session, so
# they also apply to a session that a scheduler or notebook made.
RUNTIME_SETTINGS = {
    # Event text is cut before its offset and read as UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot ids: split oversized join partitions even where that costs one more
    # shuffle above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Stream state lives off the heap; this also reaches sessions made elsewhere.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # One store for the four of a join, and a commit that writes the batch's changes only.
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Sinks replace only the partitions they write.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# For jobs of many steps: files of a step's shuffles are removed when it ends, not when the driver next collects garbage.
BRIEF_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

# Folders made for local sessions that name none.
_LOCAL_DIRS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings for as long as the block runs; a stream that starts in it keeps them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def build(app_name: str, master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Make a session; leave ``master`` unset under spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.getOrCreate())


def work_dir(spark: SparkSession) -> str:
    """The shared folder for tables, checkpoints and stream state.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder; on a cluster the setting is required,
    since executors cannot see each other's disks.
    """
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="funnelwright-")
    return _LOCAL_DIRS[application]
