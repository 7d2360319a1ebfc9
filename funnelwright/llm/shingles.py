"""Word and shingle hashes of many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
#: Bytes of text that are hashed together; a longer text is hashed alone.
CHUNK_BYTES = 1_000_000

_rng = np.random.default_rng(20240229)
_TABLE = _rng.integers(0, 2**64, (64, 256), dtype=np.uint64)
_FLAT = _TABLE.ravel()
_STRETCH = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _rng.integers(0, 2**63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK_BYTES`` of text, at least one row each."""
    sizes = pc.binary_length(texts).fill_null(0).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > CHUNK_BYTES:
            yield start, i
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of all texts' bytes, and where each begins and the last ends; nulls are empty."""
    values = texts.cast(pa.large_binary()).fill_null(b"")
    values = pa.concat_arrays([values])  # no slice offset
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(
    texts: pa.Array, lower: bool = True, breaks: np.ndarray = _SPACE, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Hash, first and past-the-end byte of every run of bytes that do not break, each
    text's first run with the total at the end, and hashes of the runs' prefixes.

    A-Z count as a-z if ``lower``. A run's hash sums random numbers drawn for its
    bytes by place; so does that of its first k bytes, 0 if it is shorter.
    """
    data, offsets = _bytes(texts)
    if lower:
        data = _LOWER[data]
    solid = ~breaks[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[firsts] = solid[firsts]
    starts = np.flatnonzero(begins)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        empty = np.zeros(0, np.int64)
        return none, empty, empty, np.zeros(len(offsets), np.int64), [none for _ in prefixes]
    kept = np.flatnonzero(solid)
    first_kept = np.flatnonzero(begins[kept])
    lengths = np.diff(np.append(first_kept, len(kept)))
    place = kept - np.repeat(starts, lengths)
    values = _FLAT.take(((place & 63) << 8) | data[kept])
    if lengths.max() > 64:
        block = place >> 6
        far = block > 0
        powers = np.cumprod(np.full(int(block.max()) + 1, _STRETCH, dtype=np.uint64))
        values[far] *= powers[block[far]]
    hashes = mix(np.add.reduceat(values, first_kept) + lengths.astype(np.uint64))
    heads = []
    if prefixes:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        for k in prefixes:
            head = total[np.minimum(first_kept + k, len(values))] - total[first_kept]
            heads.append(np.where(lengths >= k, mix(head + np.uint64(k << 32)), np.uint64(0)))
    return hashes, starts, starts + lengths, np.searchsorted(starts, offsets), heads


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``runs`` without ASCII white space."""
    return runs(texts, lower)[:4]


def shingle_sets(texts: pa.Array, size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; fewer words than ``size`` are one shingle, none is empty."""
    hashes, _, _, bounds = words(texts)
    n = len(hashes)
    if n >= size:
        grams = np.zeros(n - size + 1, dtype=np.uint64)
        for i in range(size):
            grams += hashes[i : n - size + 1 + i] * _PLACES[i]
        grams = mix(grams)
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(grams[lo : hi - size + 1]))
        elif hi > lo:
            short = (hashes[lo:hi] * _PLACES[: hi - lo]).sum(dtype=np.uint64) + np.uint64(hi - lo)
            out.append(mix(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
