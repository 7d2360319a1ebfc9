"""Runs of repeated words, found by minimizers at several scales.

A run is a stretch of words with a period that occurs in it at least four times.
Periods up to ``SHORT`` are found by a direct scan at each lag. Longer ones have
scales: the scale of size g is for periods in (g/2, g]. Stretches of g words get a
name, built by doubling from the scale before, and of every g/2 neighbouring
stretches the least name is marked. Inside a run the same mark returns one
period later, and no equal stretch stands between, since two that overlap by a
period would make the period smaller. So neighbouring marks of one name give all
candidates, and each is extended both ways, word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import WORDS, bound, documents, workers_import
from funnelwright.llm.shingles import chunks, mix

#: Longest period that is scanned for directly; a power of two.
SHORT = 8
#: Times that a period occurs in a run at least, and words of a run at least.
TIMES = 4
LEAST_WORDS = 6

_AGAIN = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64(2**32 - 1)
_UPPER = ~_PLACE

Runs = dict[tuple[int, int], int]


def _least(period: int) -> int:
    return max(LEAST_WORDS, TIMES * period)


def _note(found: Runs, start: int, end: int, period: int) -> None:
    """A stretch may show at multiples of its period too; the smallest counts."""
    if end - start >= _least(period):
        found[start, end] = min(period, found.get((start, end), period))


def _scan(ids: np.ndarray, lag: int, found: Runs) -> None:
    """All stretches whose words recur at a lag."""
    same = np.flatnonzero(ids[lag:] == ids[:-lag])
    if not len(same):
        return
    breaks = np.flatnonzero(np.diff(same) > 1)
    first = same[np.concatenate([[0], breaks + 1])]
    last = same[np.concatenate([breaks, [len(same) - 1]])]
    long = last - first + 1 + lag >= _least(lag)
    for start, end in zip(first[long].tolist(), last[long].tolist(), strict=True):
        _note(found, start, end + 1 + lag, lag)


def _agreeing(ids: np.ndarray, at: int, lag: int, step: int) -> int:
    """First place from ``at`` in a direction whose word does not recur at the lag, in growing blocks."""
    size = 64
    while True:
        lo, hi = (at, min(at + size, len(ids) - lag)) if step > 0 else (max(at - size + 1, 0), at + 1)
        if lo >= hi:
            return at
        other = np.flatnonzero(ids[lo:hi] != ids[lo + lag : hi + lag])
        if len(other):
            return lo + int(other[0 if step > 0 else -1])
        at = hi if step > 0 else lo - 1
        size *= 2


def _extend(ids: np.ndarray, marks: np.ndarray, lags: np.ndarray, found: Runs) -> None:
    """Extend each candidate unless it lies in a stretch of its lag that has been seen."""
    seen_lag, seen_end = 0, 0
    order = np.lexsort((marks, lags))
    for at, lag in zip(marks[order].tolist(), lags[order].tolist(), strict=True):
        if lag == seen_lag and at < seen_end:
            continue
        if ids[at] != ids[at + lag]:
            continue  # two names were equal by chance
        end = _agreeing(ids, at, lag, 1) + lag
        start = _agreeing(ids, at, lag, -1) + 1
        _note(found, start, end, lag)
        seen_lag, seen_end = lag, end - lag


def _marks(names: np.ndarray, window: int) -> np.ndarray:
    """Places of the least name of every ``window`` (a power of two) neighbours, the rightmost of equal ones."""
    least = (names & _UPPER) | (_PLACE - np.arange(len(names), dtype=np.uint64))
    width = 1
    while width < window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    changed = np.flatnonzero(least[1:] != least[:-1]) + 1
    return (_PLACE - (least[np.concatenate([[0], changed])] & _PLACE)).astype(np.int64)


def runs_of(ids: np.ndarray, lengths: np.ndarray) -> Runs:
    """Start, end and smallest period of every run in texts laid end to end.

    ``ids`` numbers the words from 0, the longest text first; each text, of so many
    words, is followed by a negative number that no other has, so no run crosses.
    """
    found: Runs = {}
    for lag in range(1, min(SHORT, len(ids) - 1) + 1):
        _scan(ids, lag, found)
    ends = np.cumsum(lengths + 1)
    names, size = mix(ids.astype(np.int64).view(np.uint64) * _AGAIN), 1
    while len(names) > size:
        names = mix(names[:-size] * _AGAIN + names[size:])
        size *= 2
        if size <= SHORT:
            continue
        half = size // 2
        # texts that can hold a run of a period over half the size are a prefix
        enough = int(np.searchsorted(-lengths, -TIMES * (half + 1), side="right"))
        if not enough:
            break
        names = names[: int(ends[enough - 1])]
        if len(names) <= half:
            break
        marks = _marks(names, half)
        order = np.argsort(names[marks], kind="stable")
        ordered, at = names[marks][order], marks[order]
        twice = np.flatnonzero(ordered[1:] == ordered[:-1])
        lags = at[twice + 1] - at[twice]
        fit = (lags > half) & (lags <= size)
        _extend(ids, at[twice][fit], lags[fit], found)
    return found


def _texts_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Start, length and period of every run of each text, by start and then period."""
    index: dict[bytes, int] = {}
    lengths = np.array([len(words) for words in texts], dtype=np.int64)
    order = np.argsort(-lengths, kind="stable")
    ids = np.empty(int(lengths.sum()) + len(texts), dtype=np.int64)
    at, begins = 0, []
    for i, k in enumerate(order.tolist()):
        begins.append(at)
        words = texts[k]
        ids[at : at + len(words)] = [index.setdefault(w, len(index)) for w in words]
        at += len(words) + 1
        ids[at - 1] = -1 - i
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (start, end), period in runs_of(ids, lengths[order]).items():
        i = int(np.searchsorted(begins, start, side="right")) - 1
        out[int(order[i])].append((start - begins[i], end - start, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), dtype=bool)
    for start, length, period in runs:
        gone[start + period : start + length] = True
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are separated by ASCII white space and compared as they are. Runs are
    maximal and may overlap. ``collapsed`` joins by one space the words that stand in
    no run after its first period. A null or empty text has no words, no runs and an
    empty collapse. Rows are taken one by one, however often they repeat, with no
    shuffle; a long text is searched whole in about its size times the square of the
    logarithm of the longest period. Other columns are not read.
    """
    workers_import(docs.sparkSession)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch.column(1)):
                part = batch.column(1)[lo:hi].cast(pa.large_binary())
                texts = [(t or b"").split() for t in part.to_pylist()]
                runs = _texts_runs(texts)
                collapsed = [_collapsed(w, r) for w, r in zip(texts, runs, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        pa.array([len(w) for w in texts], pa.int64()),
                        pa.array([[dict(zip(_RUN.names, r, strict=True)) for r in rs] for rs in runs], pa.list_(_RUN)),
                        pa.array(collapsed, pa.binary()).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(
        search,
        "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string",
    )


def repeated(doc_id: Column, text: Column) -> Column:
    """A text whose end repeats, where the checksum of the id is a multiple of ten; else as it is.

    From a word that the checksum chooses on, the words are one stretch again and
    again, three to ten times as long as it in all. A null id leaves the text.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def made(words: Column) -> Column:
        n = F.size(words)
        from_ = F.pmod(g, n)
        period = 1 + F.floor((n - from_) / (3 + F.pmod(g, F.lit(8))))
        place = lambda i: F.when(i < from_, i).otherwise(from_ + F.pmod(i - from_, period)).cast("int")
        joined = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, place(i))), " ")
        return F.when(n > 0, joined).otherwise(text)

    return F.when(F.pmod(h, F.lit(10)) == 0, bound(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), made)).otherwise(text)


def greatest_exponent(runs: Column) -> Column:
    """The run with the greatest length for its period, exactly; ties by start, then period. Null if none."""

    def compare(a: Column, b: Column) -> Column:
        mine, other = a["length"] * b["period"], b["length"] * a["period"]
        ties = F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise(
            F.when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0)
        )
        return F.when(mine > other, -1).when(mine < other, 1).otherwise(ties)

    return F.get(F.array_sort(runs, compare), 0)


def op13_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = periodic_runs(docs.select("doc_id", repeated(F.col("doc_id"), F.col("text")).alias("text")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("best")
    return rows.withColumn("best", greatest_exponent(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
