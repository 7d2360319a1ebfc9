"""Quality rules: plain limits, then robust multivariate outliers per language and source.

Each group's centre and scatter are minimum-covariance-determinant estimates: a
robust start (medians and median deviations), then concentration steps that
re-estimate both from the three fifths of the rows nearest so far, until the
determinant no longer falls, and one reweighting. A document whose transformed
statistics lie too far off by Mahalanobis distance is rejected. Every step is an
aggregation over a narrow stored table, so a group of any size is spread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import documents, stored, workers_import
from funnelwright.llm.shingles import _PLACES, SIZE, _bytes, chunks, mix, words

#: Part of a group that the estimates rest on, and the steps at most.
SHARE = 0.6
STEPS = 8
#: Chance that a normal document of a group lies beyond the limit.
BEYOND = 1e-6
#: A group's estimates are drawn to its language's, and these to those of all rows, as by so many documents.
SHRINK = 200
#: Words' worth of the group's mean that smooth the ratios of short texts.
SMOOTHING = 50
#: Scatter that every group has at least, by statistic, as a standard deviation. Each is under a sixth of
#: what its statistic can deviate, so that one statistic alone can reject.
FLOORS = {"word_length": 0.06, "symbols": 0.06, "repeats": 0.05, "copies": 0.10, "capitals": 0.08}
#: Groups are broadcast up to so many, of under 500 bytes each.
BROADCAST_GROUPS = 50_000
_DIM = len(FLOORS)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_PARTS = np.uint64(0xA0761D6478BD642F)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text; nulls count as empty."""
    data, offsets = _bytes(texts)
    hashes, starts, ends, bounds = words(texts, lower=False)
    letters = (data & 0xC0) != 0x80
    letters &= ~((data == 32) | ((data >= 9) & (data <= 13)))
    out = {
        "n_words": np.diff(bounds),
        "word_chars": _sums(letters, offsets),
        "n_symbols": _sums(_SYMBOLS[data], offsets),
        "n_capitals": _sums((data >= 65) & (data <= 90), offsets),
    }
    n = len(hashes)
    covered = np.zeros(n + 1, dtype=np.int64)
    if n >= SIZE:
        doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        grams = np.zeros(n - SIZE + 1, dtype=np.uint64)
        for i in range(SIZE):
            grams += hashes[i : n - SIZE + 1 + i] * _PLACES[i]
        within = np.flatnonzero(doc[: n - SIZE + 1] == doc[SIZE - 1 :])
        key = mix(mix(grams[within]) + doc[within].astype(np.uint64) * _PARTS)
        _, index, times = np.unique(key, return_inverse=True, return_counts=True)
        twice = within[times[index] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + SIZE, -1)
    out["n_repeat_words"] = _sums(np.cumsum(covered[:-1]) > 0, bounds)
    dup, filled = [], []
    raw = data.tobytes()
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        lines = [line for line in raw[lo:hi].split(b"\n") if line.strip()]
        filled.append(len(lines))
        dup.append(len(lines) - len(set(lines)))
    return out | {"n_dup_lines": np.array(dup, dtype=np.int64), "n_lines": np.array(filled, dtype=np.int64)}


def counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of every row. No shuffle."""
    workers_import(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch.column(3)):
                made = text_counts(batch.column(3)[lo:hi])
                columns = [batch.column(i)[lo:hi] for i in range(3)] + [pa.array(made[c], pa.int64()) for c in BASE]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "source", *BASE])

    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in BASE)
    asked = [F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", "text"]
    return docs.select(*asked).mapInArrow(count, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def _smoothed(part: str, whole: str, mean: str) -> Column:
    """A ratio drawn to the group's mean, the more the shorter the text."""
    return (F.col(part) + SMOOTHING * F.col(mean)) / (F.col(whole) + SMOOTHING)


def _key(*names: str) -> Column:
    """One string for a group; a null is unlike any value."""
    return F.to_json(F.struct(*names)) if names else F.lit("{}")


def statistics(rows: DataFrame) -> DataFrame:
    """Add ``x``: the transformed statistics, near normal within a group of clean texts."""
    rows = rows.withColumn("g", _key("lang", "source"))
    means = rows.groupBy("g").agg(
        *[
            (F.sum(c) / F.greatest(F.sum("n_words"), F.lit(1))).alias(f"_{c}")
            for c in ("word_chars", "n_symbols", "n_repeat_words", "n_capitals")
        ],
    )
    x = F.array(
        F.log(F.greatest(_smoothed("word_chars", "n_words", "_word_chars"), F.lit(0.1))),
        F.sqrt(_smoothed("n_symbols", "n_words", "_n_symbols")),
        F.sqrt(_smoothed("n_repeat_words", "n_words", "_n_repeat_words")),
        F.sqrt(F.col("n_dup_lines") / (F.col("n_lines") + 5)),
        F.sqrt(_smoothed("n_capitals", "n_words", "_n_capitals")),
    )
    return rows.join(_small(means), "g").withColumn("x", x).drop(*[c for c in means.columns if c != "g"])


def _small(groups: DataFrame) -> DataFrame:
    groups = stored(groups, "groups")
    return F.broadcast(groups) if groups.count() <= BROADCAST_GROUPS else groups


def _tail(x: float, dim: int) -> float:
    """Chance that a chi-square variable exceeds x."""
    q, k = (math.erfc(math.sqrt(x / 2)), 1) if dim % 2 else (math.exp(-x / 2), 2)
    while k < dim:
        k += 2
        q += (x / 2) ** (k / 2 - 1) * math.exp(-x / 2) / math.gamma(k / 2)
    return q


def chi_square_limit(beyond: float, dim: int = _DIM) -> float:
    """The value that a chi-square variable exceeds with a given chance."""
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _tail(mid, dim) > beyond else (lo, mid)
    return hi


def _kept_scatter(share: float) -> float:
    """Share of the variance that a normal sample keeps when cut at this quantile of distance."""
    return (1 - _tail(chi_square_limit(1 - share), _DIM + 2)) / share


_FLOOR = np.diag(np.array(list(FLOORS.values())) ** 2)
_ESTIMATE = "g string, n bigint, mean array<double>, inverse array<double>, logdet double"


def _estimates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Mean and inverse scatter of each group from its count and sums of products."""
    for frame in frames:
        out = []
        for row in frame.itertuples(index=False):
            mean = np.array(row.sums) / row.n
            products = np.zeros((_DIM, _DIM))
            products[np.triu_indices(_DIM)] = np.array(row.products) / row.n
            products += np.triu(products, 1).T
            scatter = (products - np.outer(mean, mean)) * row.factor + _FLOOR
            out.append((row.g, row.n, mean, np.linalg.inv(scatter).ravel(), np.linalg.slogdet(scatter)[1]))
        yield pd.DataFrame(out, columns=["g", "n", "mean", "inverse", "logdet"])


def _drawn(n: float, own, parent):
    """Mean and scatter of a group drawn to its parent's, the less the more documents it has."""
    if own is None:
        return parent
    share = n / (n + SHRINK)
    return tuple(share * a + (1 - share) * b for a, b in zip(own, parent, strict=True))


def _judges(every: tuple | None):
    """The estimates that each group is judged by: its own, drawn to its language's, drawn to those of all rows."""

    def read(mean, inverse) -> tuple | None:
        return None if mean is None else (np.array(mean), np.linalg.inv(np.reshape(inverse, (_DIM, _DIM))))

    def judge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                tongue = _drawn(row.rows_1, read(row.mean_1, row.inverse_1), read(*every))
                mean, scatter = _drawn(row.rows, read(row.mean, row.inverse), tongue)
                out.append((row.g, mean, np.linalg.inv(scatter).ravel()))
            yield pd.DataFrame(out, columns=["g", "mean", "inverse"])

    return judge


def _distance(x: str = "x") -> Column:
    """Squared Mahalanobis distance of x from a group's mean under its inverse scatter."""
    from_mean = [F.col(x)[i] - F.col("mean")[i] for i in range(_DIM)]
    terms = [
        from_mean[i] * from_mean[j] * F.col("inverse")[i * _DIM + j] * (1 if i == j else 2)
        for i in range(_DIM)
        for j in range(i, _DIM)
    ]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def _moments(near: DataFrame, factor: float) -> DataFrame:
    sums = [F.sum(F.col("x")[i]) for i in range(_DIM)]
    products = [F.sum(F.col("x")[i] * F.col("x")[j]) for i in range(_DIM) for j in range(i, _DIM)]
    agg = near.groupBy("g").agg(
        F.count("*").alias("n"), F.array(*sums).alias("sums"), F.array(*products).alias("products")
    )
    return agg.withColumn("factor", F.lit(factor)).mapInPandas(_estimates, _ESTIMATE)


def estimates(levels: DataFrame) -> DataFrame:
    """Minimum-covariance-determinant estimates of each group ``g`` of vectors ``x``."""
    medians = levels.groupBy("g").agg(
        *[F.percentile_approx(F.col("x")[i], 0.5, 1000).alias(f"m{i}") for i in range(_DIM)]
    )
    medians = _small(medians)
    deviations = levels.join(medians, "g").groupBy("g").agg(
        F.array(*[F.first(f"m{i}") for i in range(_DIM)]).alias("mean"),
        *[F.percentile_approx(F.abs(F.col("x")[i] - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i in range(_DIM)],
    )
    spread = [F.pow(F.col(f"d{i}") * 1.4826, 2) + float(_FLOOR[i, i]) for i in range(_DIM)]
    start = deviations.select(
        "g",
        "mean",
        F.array(*[1 / spread[i] if i == j else F.lit(0.0) for i in range(_DIM) for j in range(_DIM)]).alias("inverse"),
        F.lit(0).cast("bigint").alias("n"),
        F.lit(float("inf")).alias("logdet"),
    )
    now, total = _small(start), None
    for _ in range(STEPS):
        placed = levels.join(now, "g").withColumn("d2", _distance())
        cut = placed.groupBy("g").agg(F.percentile_approx("d2", SHARE, 1000).alias("cut"))
        near = placed.drop("n", "mean", "inverse", "logdet").join(_small(cut), "g").filter("d2 <= cut")
        now = _small(_moments(near, 1 / _kept_scatter(SHARE)))
        before, total = total, now.agg(F.sum("logdet")).first()[0]
        if before is not None and total is not None and total > before - 1e-3 * max(1.0, abs(before)):
            break
    inside = levels.join(now, "g").withColumn("d2", _distance()).filter(F.col("d2") <= chi_square_limit(0.025))
    return _small(_moments(inside.drop("n", "mean", "inverse", "logdet"), 1 / _kept_scatter(0.975)))


def verdicts(docs: DataFrame) -> DataFrame:
    """Base counts, ``distance``, ``base_failed`` and ``kept`` of every row.

    Null and empty texts have no words, so they fail the base rules. Estimates
    rest on rows that pass them. Null languages and sources are groups of their
    own. Every group is judged by its own estimates, drawn to those of its language
    by a weight that falls smoothly with its rows, as these are to those of all rows.
    Rows are judged alike however often they repeat. Other columns are ignored.
    """
    rows = stored(statistics(stored(counts(docs), "counts")).withColumn("base_failed", base_failed()), "statistics")
    good = rows.filter("NOT base_failed").select("lang", "source", "g", "x").withColumn("g_1", _key("lang"))
    # Rows serve each group that judges someone: their own, their language, all.
    serving = good.select(F.explode(F.array("g", "g_1", _key())).alias("g"), "x")
    found = estimates(stored(serving, "levels"))
    sizes = stored(good.groupBy("g", "g_1").agg(F.count("*").alias("rows")), "sizes")
    tongues = sizes.groupBy("g_1").agg(F.sum("rows").alias("rows_1"))

    every = found.filter(F.col("g") == _key()).select("mean", "inverse").first()  # one row of fixed size
    above = found.select(F.col("g").alias("g_1"), F.col("mean").alias("mean_1"), F.col("inverse").alias("inverse_1"))
    lined = (
        sizes.join(tongues, "g_1")
        .join(found.select("g", "mean", "inverse"), "g", "left")
        .join(above, "g_1", "left")
        .select("g", "rows", "mean", "inverse", "rows_1", "mean_1", "inverse_1")
    )
    judges = lined.mapInPandas(_judges(tuple(every) if every else None), "g string, mean array<double>, inverse array<double>")
    judges = _small(judges)
    placed = rows.join(judges, "g", "left").withColumn("distance", F.sqrt(_distance()))
    far = F.coalesce(F.col("distance") > math.sqrt(chi_square_limit(BEYOND)), F.lit(False))
    return placed.select(
        "doc_id",
        *BASE,
        "distance",
        "base_failed",
        (~F.col("base_failed") & ~far).alias("kept"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"
    )
