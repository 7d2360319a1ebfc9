"""Toxic spans by a linear-chain conditional random field, and scores of documents.

Labels say which documents are toxic, not which words. So tokens are labelled
first: a word or word beginning that toxic training documents hold and others do
not, beyond chance, marks the tokens of toxic documents. A two-label chain is
fitted to these tokens, with weights for the word and its beginnings and for
neighbouring labels. Forward-backward marginals give spans with offsets, and a
logistic curve over their sums the score of a document.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm import sketch
from funnelwright.llm.common import documents, for_workers, labels, quoted, workers_import
from funnelwright.llm.shingles import chunks, runs, shingle_sets

#: Labelled documents that the model is fitted on, at most; chosen by a hash of their ids.
SAMPLE = 2000
#: Bytes of their texts, at most.
SAMPLE_BYTES = 16 * 1024 * 1024
THRESHOLD = 0.3
#: Bytes of a word's beginnings that are features, besides the word itself.
PREFIXES = (3, 4, 5, 6, 8)
#: Tokens in a lane: documents are cut into lanes that are computed side by side and chained exactly.
LANE = 256
STEPS = 30
RIDGE = 1e-3
_BREAKS = np.ones(256, dtype=bool)
_BREAKS[48:58] = _BREAKS[65:91] = _BREAKS[97:123] = False
_BREAKS[128:] = False
_SLOTS = 1 << 22


def tokens(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Features of every token (hashes; 0: none), its first and past-the-end byte, and texts' first tokens."""
    word, starts, ends, bounds, heads = runs(texts, True, _BREAKS, PREFIXES)
    return [word, *heads], starts, ends, bounds


def _all_tokens(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and bounds of many texts, read in chunks to save memory."""
    parts, bounds = [], [np.zeros(1, np.int64)]
    for lo, hi in chunks(texts):
        features, _, _, own = tokens(texts[lo:hi])
        parts.append(features)
        bounds.append(own[1:] + bounds[-1][-1])
    features = [np.concatenate(f) for f in zip(*parts, strict=True)] or [np.zeros(0, np.uint64)]
    return features, np.concatenate(bounds)


class Lanes:
    """Tokens of many texts laid out as rows of LANE columns, each text in rows of its own."""

    def __init__(self, bounds: np.ndarray):
        lengths = np.diff(bounds)
        self.rows_of = -(-lengths // LANE)
        self.first_row = np.concatenate([[0], np.cumsum(self.rows_of)])
        self.n = int(self.first_row[-1])
        within = np.arange(int(bounds[-1])) - np.repeat(bounds[:-1], lengths)
        self.row = (np.repeat(self.first_row[:-1], lengths) + within // LANE).astype(np.int32)
        self.column = (within % LANE).astype(np.int32)
        self.filled = np.bincount(self.row, minlength=self.n)

    def spread(self, values: np.ndarray, blank: float) -> np.ndarray:
        out = np.full((LANE, self.n), blank)
        out[self.column, self.row] = values
        return out


def marginals(odds: np.ndarray, step: np.ndarray, lanes: Lanes):
    """Forward and backward probabilities by lane, and each token's probability of label 1.

    ``odds``: exp of each token's emission score; ``step``: exp of the 2 x 2
    transition scores; a text starts from either label alike.
    """
    x = lanes.spread(odds, 1.0)
    there = np.arange(LANE)[:, None] < lanes.filled[None, :]
    whole = bool(there.all())
    # Product of the steps after each lane's first token, to chain the lanes of one text.
    product = np.tile(np.eye(2)[:, :, None], (1, 1, lanes.n))
    if (lanes.rows_of > 1).any():
        for k in range(LANE):
            a = product[:, 0] * step[0, 0] + product[:, 1] * step[1, 0]
            b = (product[:, 0] * step[0, 1] + product[:, 1] * step[1, 1]) * x[k]
            scale = a[0] + b[0] + a[1] + b[1]
            new = np.stack([a / scale, b / scale], axis=1)
            product = new if whole else np.where(there[k], new, product)
    # before: label distribution just before a lane; after: backward values at its last token.
    before = np.full((2, lanes.n), 0.5)
    after = np.ones((2, lanes.n))
    for doc in np.flatnonzero(lanes.rows_of > 1).tolist():
        lo, hi = int(lanes.first_row[doc]), int(lanes.first_row[doc + 1])
        for r in range(lo + 1, hi):
            v = before[:, r - 1] @ product[:, :, r - 1]
            before[:, r] = v / v.sum()
        for r in range(hi - 2, lo - 1, -1):
            v = product[:, :, r + 1] @ after[:, r + 1]
            after[:, r] = v / v.sum()
    ahead = np.empty((LANE, 2, lanes.n))
    state = before
    for k in range(LANE):
        a = state[0] * step[0, 0] + state[1] * step[1, 0]
        b = (state[0] * step[0, 1] + state[1] * step[1, 1]) * x[k]
        scale = a + b
        state = np.stack([a / scale, b / scale])
        ahead[k] = state
    back = np.empty((LANE, 2, lanes.n))
    state = after
    for k in range(LANE - 1, -1, -1):
        # lanes that end before k keep their last value, which column filled - 1 must hold
        back[k] = state
        a = step[0, 0] * state[0] + step[0, 1] * x[k] * state[1]
        b = step[1, 0] * state[0] + step[1, 1] * x[k] * state[1]
        scale = a + b
        new = np.stack([a / scale, b / scale])
        state = new if whole else np.where(there[k], new, state)
    both = ahead[:, 1] * back[:, 1]
    p = both / (both + ahead[:, 0] * back[:, 0])
    return ahead, back, x, there, p[lanes.column, lanes.row]


@dataclass
class Model:
    """Weights by feature hash, transitions, and the curve from marginals to scores."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    step: np.ndarray
    curve: np.ndarray

    def slots(self) -> np.ndarray:
        """Which upper hash bits any known feature has; spares most lookups."""
        seen = np.zeros(_SLOTS, dtype=bool)
        seen[(self.keys >> np.uint64(42)).astype(np.int64)] = True
        return seen

    def emissions(self, features: list[np.ndarray], seen: np.ndarray) -> np.ndarray:
        out = np.full(len(features[0]), self.bias)
        if not len(self.keys):
            return out
        for f in features:
            hit = np.flatnonzero(seen[(f >> np.uint64(42)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.keys, f[hit]), len(self.keys) - 1)
            out[hit] += np.where(self.keys[at] == f[hit], self.weights[at], 0.0)
        return out

    def token_marginals(self, features: list[np.ndarray], bounds: np.ndarray, seen: np.ndarray) -> np.ndarray:
        if not len(features[0]):
            return np.zeros(0)
        odds = np.exp(np.clip(self.emissions(features, seen), -30, 30))
        return marginals(odds, np.exp(self.step), Lanes(bounds))[4]

    def scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(summary(p, bounds) @ self.curve)))


def summary(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of each text: 1, the log of the expected toxic tokens, and the largest marginal."""
    total = np.diff(np.concatenate([[0.0], np.cumsum(p)])[bounds])
    largest = np.zeros(len(bounds) - 1)
    filled = bounds[:-1] < bounds[1:]
    if len(p):
        largest[filled] = np.maximum.reduceat(p, bounds[:-1][filled])
    return np.column_stack([np.ones(len(total)), np.log1p(np.maximum(total, 0)), largest])


def _copy_weights(texts: pa.Array) -> np.ndarray:
    """One for each group of texts whose sketches share a band, dealt evenly to its members."""
    sets: list[np.ndarray] = []
    for lo, hi in chunks(texts):
        sets += shingle_sets(texts[lo:hi])
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    seen: dict[tuple[int, int], int] = {}
    for i, s in enumerate(sets):
        for band in enumerate(sketch.bands(sketch.sketch(s)).tolist()) if len(s) else [(-1, 0)]:
            parent[root(i)] = root(seen.setdefault(band, i))
    roots = np.array([root(i) for i in range(len(sets))], dtype=np.int64)
    _, inverse, counts = np.unique(roots, return_inverse=True, return_counts=True)
    return 1.0 / counts[inverse]


def _marks(feature: np.ndarray, doc: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple:
    """Distinct hashes of a feature, each token's index into them, and which of them mark toxic texts.

    A mark's documents are toxic so much more often than the rest that the
    likelihood ratio outweighs the number of hashes tried; copies count once.
    """
    values, index = np.unique(feature, return_inverse=True)
    pairs = np.unique(index.astype(np.int64) * len(toxic) + doc)
    f, d = pairs // len(toxic), pairs % len(toxic)
    n = np.bincount(f, weight[d], len(values))
    k = np.bincount(f, weight[d] * toxic[d], len(values))
    base = float((weight * toxic).sum() / weight.sum())
    share = np.clip(k / np.maximum(n, 1e-9), 1e-9, 1 - 1e-9)
    gain = k * np.log(share / base) + (n - k) * np.log((1 - share) / (1 - base))
    marked = (share >= 0.75) & (gain > math.log(len(values) + 1.0)) & (values != 0)
    return values, index, marked, n


def _pair(ahead: np.ndarray, back: np.ndarray, x: np.ndarray, step: np.ndarray, i: int, j: int) -> np.ndarray:
    """Unnormalised chance of labels i and j at a token and the next one of its lane."""
    out = ahead[:-1, i] * back[1:, j]
    out *= math.exp(step[i, j])
    if j:
        out *= x[1:]
    return out


def fit(texts: list[str], toxic: list[int]) -> Model:
    """Fit the chain and the score curve to labelled texts, on one machine.

    With one label only, or no text, every text gets the smoothed share of label 1.
    """
    y = np.array(toxic, dtype=np.float64)
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    none = np.zeros(0)
    flat = Model(none.astype(np.uint64), none, 0.0, np.zeros((2, 2)), np.zeros(3))
    flat.curve[0] = math.log(prior / (1 - prior))
    if not 0 < y.sum() < len(y):
        return flat
    column = pa.array(texts, pa.large_string())
    features, bounds = _all_tokens(column)
    if not len(features[0]):
        return flat
    weight = _copy_weights(column)
    doc = np.repeat(np.arange(len(y)), np.diff(bounds))
    label = np.zeros(len(doc), dtype=bool)
    keys, indices, offset = [], [], 0
    for f in features:
        values, index, marked, n = _marks(f, doc, y, weight)
        label |= marked[index] & (y[doc] == 1)
        useful = (n >= 2) & (values != 0)
        renamed = np.where(useful, np.cumsum(useful) - 1 + offset, -1)
        keys.append(values[useful])
        indices.append(renamed[index].astype(np.int32))
        offset += int(useful.sum())
    del features
    if not label.any():
        return flat
    target = label.astype(np.float64)
    token_weight = weight[doc]
    lanes = Lanes(bounds)
    w = np.zeros(offset + 1)  # the last is for features without a weight
    bias, step = math.log((target.sum() + 1) / (len(target) + 2)), np.zeros((2, 2))
    squares, step_squares, bias_squares = np.full(offset + 1, 1e-8), np.full((2, 2), 1e-8), 1e-8
    same_lane = lanes.row[1:] == lanes.row[:-1]
    was, now = label[:-1][same_lane].astype(int), label[1:][same_lane].astype(int)
    observed = np.zeros((2, 2))
    np.add.at(observed, (was, now), token_weight[1:][same_lane])
    lane_weight = np.zeros(lanes.n)
    lane_weight[lanes.row] = token_weight
    for _ in range(STEPS):
        odds = np.full(len(target), bias)
        for i in indices:
            odds += w[i]
        ahead, back, x, there, p = marginals(np.exp(np.clip(odds, -30, 30)), np.exp(step), lanes)
        error = (target - p) * token_weight
        gradient = -RIDGE * w
        for i in indices:
            gradient += np.bincount(np.where(i < 0, offset, i), error, offset + 1)
        gradient[offset] = 0
        squares += gradient**2
        w += 0.5 * gradient / np.sqrt(squares)
        bias_squares += error.sum() ** 2
        bias += 0.5 * error.sum() / math.sqrt(bias_squares)
        expected = np.empty((2, 2))
        share = _pair(ahead, back, x, step, 0, 0)
        for i, j in ((0, 1), (1, 0), (1, 1)):
            share += _pair(ahead, back, x, step, i, j)
        share = there[1:] * lane_weight / share
        for i in (0, 1):
            for j in (0, 1):
                expected[i, j] = (_pair(ahead, back, x, step, i, j) * share).sum()
        change = observed - expected - RIDGE * step
        change -= change.mean()
        step_squares += change**2
        step += 0.2 * change / np.sqrt(step_squares)
    every = np.concatenate(keys)
    order = np.argsort(every)
    order = order[np.abs(w[:-1][order]) > 1e-3]
    model = Model(every[order], w[:-1][order], bias, step, np.zeros(3))
    del indices, ahead, back, x, there
    model.curve = _curve(summary(model.token_marginals(_all_tokens(column)[0], bounds, model.slots()), bounds), y)
    return model


def _curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    b = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 0.05, 0.05])
        b += np.linalg.solve(hessian, x.T @ (y - p) - np.array([1e-6, 0.05, 0.05]) * b)
    return b


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, toxic and text of at most ``sample`` labelled rows whose id is not held out, in one partition.

    The rows are the first by a hash of their ids, whole texts, in this order; of
    texts that share an id, the first by a hash of the text. A row labelled twice is
    toxic if one label says so; null labels and ids do not count.
    """
    order = F.xxhash64("doc_id")
    chosen = (
        marks.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(order, "doc_id")
        .limit(sample)
    )
    one = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    )
    return one.select("doc_id", "toxic", "first.text").repartition(1).sortWithinPartitions(order, "doc_id")


def within(batches: Iterator[pa.RecordBatch], most: int) -> tuple[list[str], list[int]]:
    """Texts and labels in the order of ids, of at most so many bytes; a text that would exceed them is passed over."""
    rows, held = [], 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(2)).fill_null(0).to_pylist()
        for k, size in enumerate(sizes):
            if held + size <= most:
                rows.append(tuple(batch.column(c)[k].as_py() for c in range(3)))
                held += size
    rows.sort(key=lambda r: r[0])
    return [r[2] or "" for r in rows], [int(r[1]) for r in rows]


def train(docs: DataFrame, marks: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on ``labelled_sample``, in a task that reads it batch by batch; only the model comes to the driver."""
    workers_import(docs.sparkSession)

    def fit_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pickle.dumps(fit(*within(batches, sample_bytes)))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    found = labelled_sample(docs, marks, sample).mapInArrow(fit_sample, "model binary").first()
    return pickle.loads(found[0]) if found else fit([], [])


def tag(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``score`` and ``spans`` (start and end in code points, probability) to documents.

    A span is a run of tokens of one text that are each likelier toxic than not.
    Null and empty texts have no spans and the score of a text without toxic
    tokens. Columns of these names are replaced. No shuffle.
    """
    workers_import(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in docs.columns if c not in ("score", "spans")]
    docs = for_workers(docs, names)
    kept = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        seen = model.slots()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for lo, hi in chunks(texts):
                features, starts, ends, bounds = tokens(texts[lo:hi])
                p = model.token_marginals(features, bounds, seen)
                spans = _spans(texts[lo:hi], p, starts, ends, bounds)
                part = batch.slice(lo, hi - lo)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                columns += [pa.array(model.scores(p, bounds), pa.float64()), pa.array(spans, _SPANS)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, "score", "spans"])

    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema)
    spans = "spans array<struct<start: bigint, end: bigint, probability: double>>"
    return docs.mapInArrow(apply, f"{fields}, score double, {spans}").toDF(*names, "score", "spans")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))


def _spans(texts: pa.Array, p: np.ndarray, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    hot = np.flatnonzero(p > 0.5)
    if not len(hot):
        return out
    doc = np.searchsorted(bounds, hot, side="right") - 1
    data = [(t.as_py() or "").encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    new = np.concatenate([[True], (np.diff(hot) > 1) | (np.diff(doc) > 0)])
    groups = np.flatnonzero(new)
    for lo, hi in zip(groups.tolist(), [*groups[1:].tolist(), len(hot)], strict=True):
        d = int(doc[lo])
        text, base = data[d], int(at[d])
        first, last = int(starts[hot[lo]]) - base, int(ends[hot[hi - 1]]) - base
        start = len(text[:first].decode(errors="ignore"))
        out[d].append(
            {"start": start, "end": start + len(text[first:last].decode(errors="ignore")), "probability": float(p[hot[lo:hi]].max())}
        )
    return out


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    scored = tag(docs, train(docs, labels(spark, sf_dir)))
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        F.size("spans").cast("long").alias("n_spans"),
    )


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage of the pipeline: documents that score at or over the threshold go."""
    scored = tag(docs, train(docs, labels(spark, sf_dir)))
    return scored.filter(F.col("score") < THRESHOLD).select(*map(quoted, docs.columns))
