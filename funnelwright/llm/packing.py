"""Best-fit packing of token sequences by a configuration linear program.

Pieces matter only through their lengths, so the problem is its length
histogram. A configuration is a multiset of lengths that fits one sequence. The
linear program over all configurations is solved by multiplicative weights: each
length has a weight, the most valuable configuration under the weights is found
by knapsack dynamic programming, and the weights of the lengths it serves fall.
The solution is rounded to whole uses as far as lengths last, what is left is filled
best fit over the histogram, and every piece gets its place by its rank within its length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelwright.llm.common import documents, stored, workers_import

CAPACITY = 2048
TOKENIZER = "word_bpe_49k.json"
#: Runs of letters or signs whose ids a Python worker remembers, in two halves.
REMEMBERED = 300_000
#: Words between white space that it remembers, packed in three arrays, and how many new ones are looked up at once.
REMEMBERED_WORDS = 200_000
PORTION = 10_000
#: Rounds of the multiplicative weights.
ROUNDS = 400
#: Lengths served in a round, the part of a demand served at once, and how fast weights fall.
SEEDS = 32
STEP = 0.1
STEEPNESS = 1.0

def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


class WordIds:
    """Ids of whole texts from those of their words, each tokenized once while remembered.

    The tokenizer lowers the case and then treats each run of letters, each digit
    and each run of other signs by itself. Latin texts are split in the same way
    here; any other text is split at ASCII white space only, across which no token
    reaches. So the ids are those of the whole text, and a test compares both.
    """

    LATIN = re.compile(r"[\t-\r\x20-\u024f]*")
    RUNS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        self.ends[ends] = True
        self.ids: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known = pa.array([], pa.string())
        self.sizes, self.flat = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _whole(self, words: list[str]) -> None:
        for word, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.ids[word] = np.array(e.ids, dtype="<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Words used since the last half was full stay; those that were not are forgotten with it."""
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > REMEMBERED // 2:
            self.older, self.ids = self.ids, {}
            new = list(words)
        self.ids.update((w, self.older[w]) for w in new if w in self.older)
        new = [w for w in new if w not in self.ids]
        runs = [w for w in new if w.isalpha()]
        for start in range(0, len(runs), 2000):
            part = runs[start : start + 2000]
            # one call for many words; each word's last token is marked as an end
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, dtype="<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(part):
                self._whole(part)
                continue
            data, at = ids.tobytes(), 0
            for word, stop in zip(part, stops.tolist(), strict=True):
                self.ids[word] = data[at : 4 * stop]
                at = 4 * stop
        self._whole([w for w in new if not w.isalpha()])

    def _of_words(self, words: list[str]) -> list[bytes]:
        """Ids of words without white space."""
        out: list[bytes] = []
        for start in range(0, len(words), PORTION):
            part = words[start : start + PORTION]
            joined = " ".join(part)
            plain = self.LATIN.fullmatch(joined) and "<|" not in joined
            runs = [
                self.RUNS.findall(w.lower()) if plain or (self.LATIN.fullmatch(w) and "<|" not in w) else [w] for w in part
            ]
            used = set().union(*runs)
            if not all(map(self.ids.__contains__, used)):
                self._learn(used)
            ids = self.ids
            out += [ids[r[0]] if len(r) == 1 else b"".join([ids[run] for run in r]) for r in runs]
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Unsigned 32-bit ids of many texts on end, and where each text's begin and the last's end.

        Each distinct word between white space is looked up once: the words of the
        texts are coded after those remembered, whose codes are thus their places.
        """
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = pa.concat_arrays([self.known, lists.flatten()]).dictionary_encode()
        codes = coded.indices.to_numpy()[len(self.known) :]
        new = self._of_words(coded.dictionary[len(self.known) :].to_pylist())
        sizes = np.fromiter(map(len, new), np.int64, len(new)) // 4
        self.known = coded.dictionary
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(new), dtype="<u4")])
        ids, ends = self._gathered(codes)
        offsets = lists.offsets.to_numpy()
        if len(self.known) > REMEMBERED_WORDS:  # those of these texts stay
            used = np.unique(codes)
            self.flat = self._gathered(used)[0]
            self.known, self.sizes = self.known.take(pa.array(used)), self.sizes[used]
        return ids, ends[offsets - offsets[0]]

    def _gathered(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of remembered words on end, and the bounds of the words."""
        sizes = self.sizes[codes]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        first = np.cumsum(self.sizes) - self.sizes
        return self.flat[np.repeat(first[codes] - ends[:-1], sizes) + np.arange(ends[-1])], ends

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()


_SHARED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One for each Python worker, kept between tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    if path not in _SHARED:
        _SHARED[path] = WordIds(path)
    return _SHARED[path]


PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Each document's ids and a closing 0, cut where longer than the capacity.

    A null or empty text is the closing 0 alone. Repeated rows give repeated
    pieces. ``with_ids`` adds the ids. No shuffle.
    """
    path = tokenizer or default_tokenizer()
    workers_import(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = word_ids(path)
        for batch in batches:
            rows, ids = [], []
            found, bounds = ids_of.encode_all(batch.column(1))
            for i, doc in enumerate(batch.column(0).to_pylist()):
                data = found[bounds[i] : bounds[i + 1]].tobytes() + b"\0\0\0\0"
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        ids.append(np.frombuffer(part, dtype="<u4").astype("i4"))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), PIECE_TYPES, strict=True)]
            if columns and with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            if columns:
                yield pa.RecordBatch.from_arrays(columns, [*PIECE_NAMES, "ids"][: len(columns)])

    schema = PIECE_SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("bigint"), F.col("text")).mapInArrow(cut, schema)


def best_configurations(value: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack dynamic programming: for every room up to the capacity the best
    total value, and the index of one length in it (-1: room left over)."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        fit = np.searchsorted(lengths, room, side="right")
        best[room] = best[room - 1]
        if fit:
            total = best[room - lengths[:fit]] + value[:fit]
            k = int(total.argmax())
            if total[k] > best[room]:
                best[room], choice[room] = total[k], k
    return best, choice


def _walk(choice: np.ndarray, lengths: np.ndarray, room: int, counts: dict[int, int]) -> dict[int, int]:
    """The lengths (by index) of the best configuration for a room, added to those given."""
    while room > 0:
        k = int(choice[room])
        if k < 0:
            room -= 1
        else:
            counts[k] = counts.get(k, 0) + 1
            room -= int(lengths[k])
    return counts


def configuration_program(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict:
    """Fractional solution of the configuration program: uses of each configuration.

    A length's price is its size times a weight that falls with the part of its
    demand already covered. Each round prices all configurations at once by one
    dynamic program and takes the best one around each of the least covered
    lengths, up to a tenth of the demand of its tightest length.
    """
    covered = np.zeros(len(lengths))
    uses: dict[tuple, float] = {}
    for _ in range(rounds):
        open_ = covered < 1 - 1e-9
        if not open_.any():
            break
        price = lengths / capacity * np.exp(-STEEPNESS * covered)
        _, choice = best_configurations(price, lengths, capacity)
        waiting = np.where(open_, lengths * counts * (1 - covered), -1)
        for seed in np.argsort(-waiting, kind="stable")[:SEEDS]:
            if covered[seed] >= 1 - 1e-9:
                continue
            config = _walk(choice, lengths, capacity - int(lengths[seed]), {int(seed): 1})
            config = {k: min(c, int(counts[k])) for k, c in config.items()}
            amount = STEP * min(counts[k] / c for k, c in config.items())
            amount = min(amount, counts[seed] * (1 - covered[seed]) / config[int(seed)])
            key = tuple(sorted(config.items()))
            uses[key] = uses.get(key, 0) + amount
            for k, c in config.items():
                covered[k] += amount * c / counts[k]
    return uses


def pack_histogram(lengths: np.ndarray, counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Contents (length to how many) and number of sequences of each kind.

    Configurations are used as often as their rounded share and what is left of
    their lengths allow; the rest is placed best fit, longest first, into
    room that configurations leave and into new sequences.
    """
    order = np.argsort(lengths)
    lengths, counts = np.asarray(lengths)[order], np.asarray(counts)[order]
    left = counts.astype(np.int64).copy()
    rooms: dict[int, list[tuple[dict[int, int], int]]] = {}

    def add(content: dict[int, int], room: int, n: int) -> None:
        if n:
            rooms.setdefault(room, []).append((content, n))

    uses = configuration_program(lengths, counts, capacity) if len(lengths) else {}
    fill = lambda config: sum(int(lengths[k]) * c for k, c in config)
    for config, amount in sorted(uses.items(), key=lambda u: (-fill(u[0]), -u[1], u[0])):
        n = min([int(amount + 0.5), *(int(left[k] // c) for k, c in config)])
        if n <= 0:
            continue
        for k, c in config:
            left[k] -= n * c
        add({int(lengths[k]): c for k, c in config}, capacity - fill(config), n)
    for k in np.argsort(-lengths):
        length, wanted = int(lengths[k]), int(left[k])
        while wanted:
            room = min((r for r, kinds in rooms.items() if r >= length and kinds), default=None)
            if room is None:
                each = min(capacity // length, wanted)
                n = wanted // each
                add({length: each}, capacity - each * length, n)
                wanted -= n * each
                continue
            content, n = rooms[room].pop()
            each = min(room // length, max(wanted // n, 1))
            used = min(n, wanted // each)
            add({**content, length: content.get(length, 0) + each}, room - each * length, used)
            add(content, room, n - used)
            wanted -= used * each
    return [kind for room in sorted(rooms) for kind in rooms[room]]


def placement(kinds: list[tuple[dict[int, int], int]]) -> pd.DataFrame:
    """For each length the ranks that each kind of sequence takes, and where they go."""
    rows, first, taken = [], 0, {}
    for content, n in kinds:
        offset = 0
        for length in sorted(content, reverse=True):
            each = content[length]
            start = taken.get(length, 0)
            rows.append((length, start, first, each, offset))
            taken[length] = start + n * each
            offset += length * each
        first += n
    return pd.DataFrame(rows, columns=["length", "rank", "first", "each", "offset"]).sort_values(["length", "rank"])


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with ``doc_id``, ``piece`` and ``length``.

    The driver sees the length histogram, of at most ``capacity`` rows. A piece's
    rank within its length is its number within (part, length) plus the counts of
    the parts before, so no length is gathered in one task, however common.
    """
    kept = stored(cut.withColumn("_part", F.spark_partition_id()), "pieces")
    per_part = kept.groupBy("_part", "length").agg(F.count("*").alias("n"))
    histogram = kept.groupBy("length").agg(F.count("*").alias("n")).toPandas()
    kinds = pack_histogram(histogram["length"].to_numpy(), histogram["n"].to_numpy(), capacity)
    where = placement(kinds)
    scale = int(histogram["n"].max()) + 1 if len(histogram) else 1
    keys = (where["length"] * scale + where["rank"]).to_numpy()
    table = where[["rank", "first", "each", "offset"]].to_numpy()

    parts = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_part.withColumn("_before", F.coalesce(F.sum("n").over(parts), F.lit(0))).drop("n")
    within = Window.partitionBy("_part", "length").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (
        kept.withColumn("_number", F.row_number().over(within) - 1)
        .join(before, ["_part", "length"])
        .withColumn("_rank", F.col("_number") + F.col("_before"))
        .drop("_part", "_number", "_before")
    )
    names = [c for c in ranked.columns if c != "_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            row = table[np.searchsorted(keys, length * scale + rank, side="right") - 1]
            at = rank - row[:, 0]
            columns = [batch.column(c) for c in names]
            sequence = pa.array(row[:, 1] + at // row[:, 2], pa.int64())
            offset = pa.array(row[:, 3] + at % row[:, 2] * length, pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, sequence, offset], [*names, "sequence_id", "offset"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return ranked.mapInArrow(place, fields + ", sequence_id bigint, offset bigint")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(documents(spark, sf_dir))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage of the pipeline: where each piece of each document goes."""
    return pack(pieces(docs)).select(*PIECE_NAMES, "sequence_id", "offset")
