"""SentencePiece encoding and decoding by Viterbi search over an automaton.

An Aho-Corasick automaton holds all pieces. It reads a text once; at each
position its output links name the pieces that end there, longest first, and
each relaxes the best score of the position. Scores are those of the model, also
for models that were trained by merges: the result is the best-scoring
segmentation, which for those is not the order of their merges.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelwright.llm.common import documents, for_workers, quoted, workers_import
from funnelwright.llm.shingles import chunks

MODEL = "piece_bpe_32k.model"
#: Units whose ids a Python worker remembers.
REMEMBERED = 200_000
#: An unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0
SPACE = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Pieces:
    """Encoder and decoder of one model file.

    No piece holds a space mark after another character (checked on loading), so
    a text is searched in units: marks and what follows up to the next mark.
    Units end at a line break too if no piece holds one.
    """

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.automaton = ahocorasick.Automaton()
        self.single: set[str] = set()
        self.bytes: list[bytes] = []
        byte_ids, worst, characters, crossing = {}, 0.0, set(), False
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                continue
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
                continue
            score = model.get_score(i)
            worst = min(worst, score)
            self.automaton.add_word(piece, (len(piece), i, score))
            self.bytes.append(piece.replace(SPACE, " ").encode())
            characters.update(piece)
            crossing |= SPACE in piece.lstrip(SPACE)
            if len(piece) == 1:
                self.single.add(piece)
        self.automaton.make_automaton()
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.unknown = model.unk_id()
        self.byte_ids = [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else None
        unit = rf"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if "\n" not in characters else rf"{SPACE}*[^{SPACE}]+|{SPACE}+"
        self.units = re.compile(r"(?s).+" if crossing else unit)
        self.known: dict[str, bytes] = {}

    def search(self, unit: str) -> list[int]:
        """Ids of the best-scoring segmentation of a unit; of equals the longest last piece."""
        n = len(unit)
        best, back = [float("-inf")] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = 0.0
        done = 0  # every position up to here is final
        for last, (length, piece, score) in self.automaton.iter(unit):
            end = last + 1
            while done < last:
                done += 1
                self._unknown(unit, done, best, back)
            start = end - length
            total = best[start] + score
            if total > best[end]:
                best[end], back[end] = total, (start, piece)
        while done < n:
            done += 1
            self._unknown(unit, done, best, back)
        out, end = [], n
        while end:
            start, piece = back[end]
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(unit[start:end].encode())]
            else:
                out.append(self.unknown)
            end = start
        return out[::-1]

    def _unknown(self, unit: str, end: int, best: list, back: list) -> None:
        if unit[end - 1] not in self.single:
            total = best[end - 1] + self.unknown_score
            if total > best[end]:
                best[end], back[end] = total, (end - 1, -1)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        if not text:
            return b""
        units = self.units.findall(SPACE + text.replace(" ", SPACE))
        try:
            return b"".join(map(self.known.__getitem__, units))
        except KeyError:
            out = []
            for start in range(0, len(units), REMEMBERED // 4):
                part = units[start : start + REMEMBERED // 4]
                new = set(part).difference(self.known)
                if len(new) + len(self.known) > REMEMBERED:
                    self.known.clear()
                    new = set(part)
                for unit in new:
                    self.known[unit] = np.array(self.search(unit), dtype="<i4").tobytes()
                out += map(self.known.__getitem__, part)
            return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts before it."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_SHARED: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _SHARED:
        _SHARED[path] = Pieces(path)
    return _SHARED[path]


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Add ``ids`` (array of int) to documents; null and empty texts have none.

    A column of that name is replaced. No shuffle.
    """
    path = model or default_model()
    workers_import(docs.sparkSession)
    names = [c for c in docs.columns if c != "ids"]
    docs = for_workers(docs, names)
    kept = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for lo, hi in chunks(texts):
                coded = [pieces.encode(t.as_py() or "") for t in texts[lo:hi]]
                offsets = np.cumsum([0, *[len(c) // 4 for c in coded]])
                ids = pa.ListArray.from_arrays(
                    pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
                )
                part = batch.slice(lo, hi - lo)
                columns = [part.column(part.schema.get_field_index(c)) for c in kept]
                yield pa.RecordBatch.from_arrays([*columns, ids], [*kept, "ids"])

    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(apply, f"{fields}, ids array<int>").toDF(*names, "ids")


def decode(coded: DataFrame, model: str | None = None) -> DataFrame:
    """Add ``decoded`` to rows with ``ids``; null ids decode to an empty text."""
    path = model or default_model()
    workers_import(coded.sparkSession)
    names = [c for c in coded.columns if c != "decoded"]
    coded = for_workers(coded, names)
    kept = coded.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            texts = pa.array([pieces.decode(i.as_py() or []) for i in ids], pa.string())
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, texts], [*kept, "decoded"])

    fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in coded.schema)
    return coded.mapInArrow(apply, f"{fields}, decoded string").toDF(*names, "decoded")


def op3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether they decode to it again."""
    path = default_model()
    workers_import(spark)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path)
        for batch in batches:
            for lo, hi in chunks(batch.column(1)):
                rows = batch.slice(lo, hi - lo)
                coded, digests, same = [], [], []
                for t in rows.column(1):
                    text = t.as_py() or ""
                    coded.append(pieces.encode(text))
                    decoded = pieces.decode(np.frombuffer(coded[-1], dtype="<i4").tolist())
                    digests.append(hashlib.sha256(decoded.encode()).hexdigest())
                    same.append(decoded == text)
                counts = [len(c) // 4 for c in coded]
                ids = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *counts]), pa.int32()),
                    pa.array(np.frombuffer(b"".join(coded), dtype="<i4")),
                )
                columns = [rows.column(0), pa.array(counts, pa.int64()), ids, pa.array(digests), pa.array(same)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids", "decoded_sha256", "round_trip"])

    schema = "doc_id bigint, n_tokens bigint, ids array<int>, decoded_sha256 string, round_trip boolean"
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), "text")
    return docs.mapInArrow(both, schema)
