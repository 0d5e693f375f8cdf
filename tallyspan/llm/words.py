"""Word and n-gram hashes of whole texts, computed over the bytes of an Arrow column.

A word's hash is a polynomial over a table of random byte values, taken from one running sum over the
chunk, so no Python string is made. Texts are cut into chunks of whole documents only to bound memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256).astype(U64) * U64(2) + U64(1)
_PLACE = np.random.default_rng(7).integers(1, 1 << 63, 64).astype(U64) * U64(2) + U64(1)

_bytes = np.arange(256)
LOWER = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)
#: True for bytes of a word: all but ASCII white space.
SPACED = ~np.isin(_bytes, [0x20, *range(0x09, 0x0E)])
#: True for letters, digits and all bytes of non-ASCII characters: punctuation separates words.
ALNUM = (_bytes >= 128) | np.isin(_bytes, [*range(48, 58), *range(65, 91), *range(97, 123)])

_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n``; those for a chunk are kept, those for a longer text are not."""
    if n <= CHUNK_BYTES and _powers:
        return _powers[0]
    size = max(CHUNK_BYTES, n)
    up, down = np.full(size, _BASE, U64), np.full(size, _INVERSE, U64)
    up[:1] = down[:1] = 1
    table = np.multiply.accumulate(up), np.multiply.accumulate(down)
    if n <= CHUNK_BYTES:
        _powers.append(table)
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and each row's bounds in them; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), bounds


def chunks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of about CHUNK_BYTES; a longer text is a run of its own."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        yield first, last
        first = last


def word_spans(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of adjacent rows in ``data``, and each row's first word number."""
    inside = table[data]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    cut = bounds[:-1]
    cut = cut[cut < len(data)]
    start[cut] = inside[cut]
    cut = cut[cut > 0] - 1
    stop[cut] = inside[cut]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(stop) + 1, np.searchsorted(starts, bounds)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``data``, from one running sum over all bytes."""
    up, down = _power_table(len(data))
    running = np.empty(len(data) + 1, U64)
    running[0] = 0
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=running[1:])
    return mix((running[ends] - running[starts]) * down[starts])


def word_hashes(data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
    """(hash of each word, its start, its end, each row's first word number); A-Z are lower-cased."""
    starts, ends, first = word_spans(data, bounds, table)
    return span_hashes(LOWER[data], starts, ends), starts, ends, first


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words (one fewer run for each word past the first n - 1)."""
    if len(words) < n:
        return np.empty(0, U64)
    total = words[: len(words) - n + 1] * _PLACE[0]
    for k in range(1, n):
        total = total + words[k : len(words) - n + 1 + k] * _PLACE[k]
    return mix(total)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text is one shingle of all its words, no words none."""
    if len(words) == 0:
        return np.empty(0, U64)
    if len(words) < n:
        return grams(words, len(words)) + U64(len(words))
    found = np.sort(grams(words, n))
    return found[np.concatenate(([True], found[1:] != found[:-1]))]


def rows_of_words(column: pa.Array, table: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, word hashes) of every row of a string column."""
    data, bounds = text_bytes(column)
    for first, last in chunks(bounds):
        own = bounds[first : last + 1] - bounds[first]
        hashes, _, _, at = word_hashes(data[bounds[first] : bounds[last]], own, table)
        for k in range(last - first):
            yield first + k, hashes[at[k] : at[k + 1]]
