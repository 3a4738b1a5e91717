"""Words of UTF-8 texts as 64-bit hashes, for whole Arrow batches at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are taken in slices of about this many bytes, which bounds the working arrays.
SLICE_BYTES = 1 << 19

_random = np.random.default_rng(20240229)
#: A random number for each byte value; the base of the polynomial, odd and so invertible.
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = _BYTE[_LOWER]  # A-Z count as a-z, no other letter changes
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets into them) of runs of rows; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without ASCII white space), and where each text's words begin; one more at the end."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True  # a text's end ends its last word
    begins, ends = word.copy(), word.copy()
    begins[1:] &= ~word[:-1] | edge[1:n]
    ends[:-1] &= ~word[1:] | edge[1:n]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    powers, inverses = _up_to(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers, out=sums[1:])
    hashes = mix((sums[ends] - sums[begins]) * inverses[begins] + (ends - begins).astype(np.uint64))
    return hashes, np.searchsorted(begins, offsets, side="left")


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its word shingles; fewer words make one shingle, none make none."""
    for _, _, data, offsets in slices(texts):
        hashes, at = word_hashes(data, offsets)
        rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            rolled += hashes[k : k + len(rolled)] * _up_to(words + 1)[0][k + 1]
        rolled = mix(rolled)
        for begin, end in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if end - begin >= words:
                yield np.unique(rolled[begin : end - words + 1])
            elif end > begin:
                powers = _up_to(words + 1)[0][1 : end - begin + 1]
                yield mix((hashes[begin:end] * powers).sum(dtype=np.uint64, keepdims=True) ^ np.uint64(end - begin))
            else:
                yield np.zeros(0, np.uint64)


def digest(hashes: np.ndarray) -> bytes:
    """16 bytes that stand for a whole set of shingles."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
