"""Word and shingle hashes of whole batches of texts, with numpy inside a task."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0`` to ``base ** n`` modulo 2 ** 64."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]), dtype=np.uint64)


#: Words of more bytes are named by a digest.
LONG_WORD = 128
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LETTER = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)
_LETTER[65:91] = _LETTER[97:123]
_UP = powers(int(_BASE), _BLOCK + 1)
_DOWN = powers(pow(int(_BASE), -1, 1 << 64), _BLOCK + 1)
_PLACE = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit."""
    x = x + np.uint64((seed * 0x632BE59BD9B4E019 + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: np.ndarray, borders: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word in a block (words ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased); none crosses a border."""
    n = len(data)
    up, down = (_UP, _DOWN) if n <= _BLOCK else (powers(int(_BASE), n), powers(pow(int(_BASE), -1, 1 << 64), n))
    letter = ~_SPACE[data]
    apart = np.zeros(n + 1, bool)
    apart[borders] = apart[0] = apart[n] = True
    starts = np.flatnonzero(letter & (apart[:-1] | np.concatenate([[True], ~letter[:-1]])))
    ends = np.flatnonzero(letter & (apart[1:] | np.concatenate([~letter[1:], [True]]))) + 1
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LETTER[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    # Sums modulo 2 ** 64 tell regular words of a thousand letters and more badly apart, so long ones are digested.
    for k in np.flatnonzero(ends - starts > LONG_WORD):
        word = data[starts[k] : ends[k]].tobytes().translate(_LOWER)
        hashes[k] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return hashes, starts + base


def batch_words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of rows, in order: all word hashes, and begin and end of each row's words among them.

    Null texts have none. Works on about a megabyte at once, so memory does not grow with the batch.
    """
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = row + 1
        while end < len(column) and offsets[end + 1] - offsets[row] <= _BLOCK:
            end += 1
        borders, at, stop = offsets[row : end + 1], int(offsets[row]), int(offsets[end])
        found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
        while at < stop:
            cut = _cut(data, at, stop)
            found.append(_word_hashes(data[at:cut], borders[(borders > at) & (borders < cut)] - at, at))
            at = cut
        hashes, starts = (np.concatenate(part) for part in zip(*found, strict=True))
        bounds = np.searchsorted(starts, borders)
        yield hashes, np.column_stack([bounds[:-1], bounds[1:]])
        row = end


def _cut(data: np.ndarray, at: int, stop: int) -> int:
    """End of the next block: at white space, however far away."""
    cut = at + _BLOCK
    while cut < stop:
        blanks = np.flatnonzero(_SPACE[data[cut : cut + 4096]])
        if len(blanks):
            return cut + int(blanks[0])
        cut += 4096
    return stop


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; of the whole sequence if it is shorter."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        return mix((words * _PLACE[:n]).sum(keepdims=True) + np.uint64(n), 1)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += words[k : n - size + 1 + k] * _PLACE[k]
    return np.unique(mix(total))
