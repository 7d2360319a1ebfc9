"""Fast similarity sketching and its bands.

Dahlgaard, Knudsen, Thorup: Fast Similarity Sketching (FOCS 2017). In round i of
the first T every element falls into a hashed bin; in round T + i every element
falls into bin i. A bin keeps the smallest value of the earliest round that
reached it, and rounds stop once no bin is empty, so every coordinate fills, and
agreeing coordinates estimate the Jaccard likeness with the concentration of
independent draws, in little more than one pass over the set.
"""

from __future__ import annotations

import numpy as np

from funnelwright.llm.shingles import mix

BINS = 128
ROWS = 4
BANDS = BINS // ROWS

_rng = np.random.default_rng(17092017)
_SEEDS = _rng.integers(0, 2**64, 2 * BINS, dtype=np.uint64)
_LOW = np.uint64((1 << 48) - 1)
_UNSET = np.uint64(2**64 - 1)
_ROUND = np.uint64(48)
_BIN = np.uint64(64 - 7)
_BAND = _rng.integers(0, 2**63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
assert BINS == 128, "a bin is the upper seven bits of a hash"


def sketch(elements: np.ndarray) -> np.ndarray:
    """The BINS coordinates of a set of 64-bit hashes that is not empty."""
    bins = np.full(BINS, _UNSET)
    step = max(1, 512 // len(elements))
    done = 0
    while done < BINS:
        rounds = np.arange(done, min(done + step, BINS), dtype=np.uint64)
        drawn = mix(elements[None, :] ^ _SEEDS[done : done + len(rounds), None])
        value = (rounds << _ROUND)[:, None] | (drawn & _LOW)
        np.minimum.at(bins, (drawn >> _BIN).astype(np.int64).ravel(), value.ravel())
        done += len(rounds)
        if (bins != _UNSET).all():
            break
    empty = np.flatnonzero(bins == _UNSET)
    for b in empty.tolist():
        drawn = mix(elements ^ _SEEDS[BINS + b])
        bins[b] = (np.uint64(BINS + b) << _ROUND) | (drawn & _LOW).min()
    return bins


def bands(coordinates: np.ndarray) -> np.ndarray:
    """One hash for each group of ROWS coordinates."""
    return mix((coordinates.reshape(BANDS, ROWS) * _BAND).sum(axis=1, dtype=np.uint64))
