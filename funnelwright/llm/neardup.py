"""Near-duplicate documents: fast similarity sketches, banding, exact links, components.

1. Equal shingle sets are one class, represented by its smallest id.
2. Classes whose sketches agree in a band are candidates. Each is tied to the
   smallest of its bucket only; the components of these ties are coarse clusters,
   which hold every pair of candidates without listing any.
3. Within a cluster all pairs are compared on full sets, in blocks of bounded
   size. In a cluster of many blocks, members are compared with a few pivots
   first; then those outside its largest component with everyone. So pairs inside
   the largest component, however many, are never formed, and no link is lost.
4. The components of the links are the groups; the smallest id stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm import sketch
from funnelwright.llm.common import documents, stored, workers_import
from funnelwright.llm.components import components
from funnelwright.llm.shingles import chunks, mix, shingle_sets

#: Sets are linked if PERCENT * |union| <= 100 * |intersection|.
PERCENT = 75
#: Classes compared with each other in one task at once, and pivots of a larger cluster.
BLOCK = 512
PIVOTS = 64
#: Columns of the membership matrix that are multiplied at once.
WIDTH = 4096
#: Clustered ids are broadcast to the scan of texts up to so many rows of 16 bytes.
BROADCAST_IDS = 500_000

_SIGNED = np.int64


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi in chunks(batch.column(1)):
            sets = shingle_sets(batch.column(1)[lo:hi])
            first, second, tied = [], [], []
            for s in sets:
                first.append(int(mix(s).sum(dtype=np.uint64).astype(_SIGNED)))
                second.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(_SIGNED)))
                tied.append(sketch.bands(sketch.sketch(s)).astype(_SIGNED) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0)[lo:hi],
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(tied, pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "s1", "s2", "bands"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, size and 128-bit digest of the shingle set, and the bands of its sketch."""
    workers_import(docs.sparkSession)
    schema = "doc_id bigint, n_shingles bigint, s1 bigint, s2 bigint, bands array<bigint>"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(_signatures, schema)


def coarse_clusters(classes: DataFrame) -> DataFrame:
    """``rep`` and ``cluster`` of classes that share a band with another one."""
    tied = classes.select("rep", F.posexplode("bands").alias("band", "key"))
    buckets = tied.groupBy("band", "key").agg(F.min("rep").alias("b"), F.count("*").alias("n")).filter("n > 1")
    ties = tied.join(buckets, ["band", "key"]).filter("rep <> b").select(F.col("rep").alias("a"), "b").distinct()
    return components(ties, "ties").select(F.col("node").alias("rep"), F.col("component").alias("cluster"))


def linked(left: list[np.ndarray], right: list[np.ndarray], percent: int = PERCENT) -> np.ndarray:
    """For every pair of a left and a right set whether they are linked.

    Intersections are products of 0/1 membership matrices over the shingles that
    occur more than once, a few thousand columns at a time.
    """
    sizes = [np.array([len(s) for s in side], dtype=np.int64) for side in (left, right)]
    every = np.concatenate([*left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), np.concatenate(sizes))
    _, column, times = np.unique(every, return_inverse=True, return_counts=True)
    shared = times > 1
    renamed = np.cumsum(shared) - 1
    kept = shared[column]
    row, column = row[kept], renamed[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(left), len(right)), dtype=np.float64)
    for start in range(0, int(shared.sum()), WIDTH):
        lo, hi = np.searchsorted(column, [start, start + WIDTH])
        member = np.zeros((len(left) + len(right), WIDTH), dtype=np.float32)
        member[row[lo:hi], column[lo:hi] - start] = 1
        common += member[: len(left)] @ member[len(left) :].T
    union = sizes[0][:, None] + sizes[1][None, :] - common
    return 100 * common >= percent * union


def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the matrix connects: pairs of (node, root).

    Left nodes are numbered from 0, right ones after them.
    """
    n_left, n_right = links.shape
    seen_left, seen_right = np.zeros(n_left, bool), np.zeros(n_right, bool)
    out = []
    for root in range(n_left):
        if seen_left[root]:
            continue
        front = np.array([root])
        seen_left[root] = True
        while len(front):
            reached = links[front].any(axis=0) & ~seen_right
            seen_right |= reached
            right = np.flatnonzero(reached)
            out += [(int(n_left + r), root) for r in right]
            back = links[:, right].any(axis=1) & ~seen_left
            seen_left |= back
            front = np.flatnonzero(back)
            out += [(int(x), root) for x in front]
    return out


def _compare(key: list, ids: list, sides: list, texts: list) -> list[tuple[int, int]]:
    """Links among the rows of one group; side 0 is compared with side 1, side 2 with itself."""
    sets: list[np.ndarray] = []
    column = pa.array(texts, pa.large_string())
    for lo, hi in chunks(column):
        sets += shingle_sets(column[lo:hi])
    left = [i for i, s in enumerate(sides) if s != 1]
    right = [i for i, s in enumerate(sides) if s != 0]
    if not left or not right:
        return []
    places = left + right
    links = linked([sets[i] for i in left], [sets[i] for i in right])
    pairs = {(ids[places[a]], ids[places[b]]) for a, b in forest(links)}
    return [p for p in pairs if p[0] != p[1]]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Groups arrive sorted by cluster and block; one is held at a time."""
    key, rows, out = None, ([], [], []), []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for *group, rep, side, text in zip(*columns, strict=True):
            if group != key:
                if key is not None:
                    out += _compare(key, *rows)
                key, rows = group, ([], [], [])
            for held, x in zip(rows, (rep, side, text), strict=True):
                held.append(x)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])
            out = []
    if key is not None:
        out = _compare(key, *rows)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b"])


_KEY = ("cluster", "i", "j")


def _verified(grouped: DataFrame) -> DataFrame:
    """Links within groups of (cluster, i, j), over columns rep, side, text."""
    spread = grouped.select(*_KEY, "rep", "side", "text").repartition(*_KEY).sortWithinPartitions(*_KEY)
    return spread.mapInArrow(_links, "a bigint, b bigint")


def _block(n: Column) -> Column:
    return F.pmod(F.xxhash64("rep"), n).cast("int")


def links(docs: DataFrame, clusters: DataFrame, repeated: bool = True) -> DataFrame:
    """Enough links ``a``, ``b`` to connect all linked classes.

    ``repeated``: ids may occur in several rows, of which equal ones count once.
    """
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("m"))
    clusters = stored(clusters.join(sizes, "cluster"), "clusters")
    wanted = clusters.select("rep", "cluster", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    if clusters.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(wanted, "rep")
    if repeated:
        texts = texts.dropDuplicates(["rep", "text"])
    texts = stored(texts.withColumn("block", _block(F.col("blocks"))), "texts")
    zero = F.lit(0).alias
    small = texts.filter("blocks = 1").select("cluster", zero("i"), zero("j"), "rep", F.lit(2).alias("side"), "text")
    found = _verified(small)
    large = texts.filter("blocks > 1")
    counts = clusters.filter(F.col("m") > BLOCK).select("cluster", "m")
    if counts.isEmpty():
        return stored(found, "links")

    # Pivots: of every block the least few by hash, then of the cluster.
    pivots = _least(large.select("cluster", "rep", "block"), PIVOTS)
    pivot_rows = large.join(pivots, ["cluster", "rep"])
    to_blocks = pivot_rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first = large.select("cluster", F.col("block").alias("i"), zero("j"), "rep", F.lit(1).alias("side"), "text")
    first = first.unionByName(
        to_blocks.select("cluster", "i", zero("j"), "rep", F.lit(0).alias("side"), "text")
    )
    found = stored(found.unionByName(_verified(first)), "first-links")

    groups = components(found, "first")
    member = large.select("cluster", "rep", "blocks").join(
        groups.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("component", F.coalesce("component", "rep"))
    count = member.groupBy("cluster", "component").agg(F.count("*").alias("n"))
    main = count.groupBy("cluster").agg(F.max(F.struct("n", "component")).alias("main")).select(
        "cluster", F.col("main.component").alias("main")
    )
    rest = member.join(main, "cluster").filter("component <> main").select("cluster", "rep")
    n_rest = rest.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("lefts"))
    rest = stored(rest.join(n_rest, "cluster"), "rest")
    lefts = (
        large.join(rest, ["cluster", "rep"])
        .withColumn("i", _block(F.col("lefts")))
        .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(*_KEY, "rep", F.lit(0).alias("side"), "text")
    )
    rights = (
        large.join(rest.select("cluster", "lefts").distinct(), "cluster")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1)))
        .select("cluster", "i", F.col("block").alias("j"), "rep", F.lit(1).alias("side"), "text")
    )
    return stored(found.unionByName(_verified(lefts.unionByName(rights))), "links")


def _least(members: DataFrame, n: int) -> DataFrame:
    """The n members of each cluster with the least hashes, chosen in two steps."""
    entry = F.struct(F.xxhash64("rep", F.lit(1)).alias("h"), "rep")
    of_block = members.groupBy("cluster", "block").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, n).alias("least"))
    of_cluster = (
        of_block.select("cluster", F.explode("least").alias("e"))
        .groupBy("cluster")
        .agg(F.slice(F.array_sort(F.collect_list("e")), 1, n).alias("least"))
    )
    return of_cluster.select("cluster", F.explode("least.rep").alias("rep"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row.

    Null texts and texts without words have no shingles and are linked with
    nothing. Rows with one id belong to one class each by text; their groups are
    joined, as their id is the same. A null id takes part as the largest id.
    Other columns are ignored.
    """
    docs = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("doc_id"), "text")
    signed = stored(signatures(docs), "signatures")
    full = signed.filter("n_shingles > 0")
    by_set = ["n_shingles", "s1", "s2"]
    classes = full.groupBy(*by_set).agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = stored(classes, "classes")
    repeated = not signed.groupBy("doc_id").count().filter("count > 1").isEmpty()
    groups = components(links(docs, coarse_clusters(classes), repeated), "groups")
    reps = (
        classes.drop("bands")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(*by_set, F.coalesce("component", "rep").alias("component_id"))
    )
    out = signed.drop("bands").join(reps, by_set, "left")
    component = F.coalesce("component_id", "doc_id")
    plain = F.when(F.col("doc_id") < 2**63 - 1, F.col("doc_id"))
    return out.select(
        plain.alias("doc_id"),
        "n_shingles",
        F.when(component < 2**63 - 1, component).alias("component_id"),
        (component == F.col("doc_id")).alias("kept"),
    )


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the pipeline: of each group the document with the smallest id stays."""
    gone = near_duplicates(docs).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
