"""Words of a text and their hashes, a whole text at a time in numpy."""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20_240_607)
#: A random 64-bit value for each byte value, and an odd factor for each place in a window.
BYTE_VALUES = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_FACTORS = _SEED.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)

#: Which bytes are part of a word that ends at white space: all but space and \t to \r.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
#: Which bytes are part of a word of letters and digits: 0-9, A-Z, a-z and all beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x41:0x5B] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a one-to-one map)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_POWERS = np.multiply.accumulate(np.full(64, _STEP, dtype=np.uint64))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.multiply.accumulate(np.full(max(n, 2 * len(_POWERS)), _STEP, dtype=np.uint64))
    return _POWERS


def words_of(
    data: bytes, in_word: np.ndarray = NOT_SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word of the text, in order: a 64-bit hash, its first byte, its length."""
    buf = np.frombuffer(data, dtype=np.uint8)
    inside = in_word[buf]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
    if not len(lengths):
        return np.empty(0, dtype=np.uint64), starts, lengths
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    values = BYTE_VALUES[buf[inside]] * _powers(int(lengths.max()))[place]
    return mix(np.add.reduceat(values, first) + lengths.astype(np.uint64)), starts, lengths


def word_hashes(data: bytes, in_word: np.ndarray = NOT_SPACE) -> np.ndarray:
    """A 64-bit hash for each word of the text, in order."""
    return words_of(data, in_word)[0]


def prefix_hashes(data: bytes, starts: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each start on, unlike that of a whole word."""
    buf = np.frombuffer(data, dtype=np.uint8)
    total = np.zeros(len(starts), dtype=np.uint64)
    for k in range(size):
        total += BYTE_VALUES[buf[starts + k]] * _powers(size)[k]
    return mix(total ^ np.uint64(0x5555_0000_0000_0000 + size))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total += words[i : i + n] * PLACE_FACTORS[i]
    return mix(total + np.uint64(size))


def shingles(text: str, size: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's word shingles, A-Z lower-cased."""
    return np.unique(window_hashes(word_hashes(text.encode("utf-8", "surrogatepass").lower()), size))
