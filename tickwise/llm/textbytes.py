"""Whole-batch text work on UTF-8 bytes: an Arrow string column is seen as one
byte array with document bounds, and words are found and hashed with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Random 64-bit weights of the word hash: one a byte value, one a position.
_POSITIONS = 4096
_rng = np.random.default_rng(20240229)
BYTE_WEIGHT = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POSITION_WEIGHT = _rng.integers(1, 1 << 63, _POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

# A-Z to a-z on bytes.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words cut at white space only.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False

# Bytes of words by the decontamination contract, in lower-cased text.
IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[48:58] = IS_WORD[97:123] = IS_WORD[128:] = True


def pieces_of(column: pa.Array, most_bytes: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a string column into runs of rows of about ``most_bytes`` (a longer
    text makes a run of its own). Gives ``first row, row count, bytes,
    bounds``; row i of the run is ``bytes[bounds[i]:bounds[i + 1]]``. A null is
    an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(bounds, bounds[at] + most_bytes, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to - at, raw[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at]
        at = to


def word_runs(data: np.ndarray, bounds: np.ndarray, table: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes; no run crosses a text's end."""
    inside = table[data]
    n = len(data)
    if n == 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    before = np.empty(n, dtype=bool)
    before[0] = False
    before[1:] = inside[:-1]
    cuts = bounds[(bounds > 0) & (bounds < n)]
    before[cuts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, dtype=bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[cuts - 1] = False
    return starts, np.flatnonzero(inside & ~after) + 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run; equal runs have equal hashes. A run is
    hashed in blocks of ``_POSITIONS`` bytes; from the second one on, the
    block's number is mixed in, so blocks cannot change places."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    if int(lengths.max()) <= _POSITIONS:
        out = _weighted_sums(data, starts, lengths)
    else:
        blocks = np.maximum(-(-lengths // _POSITIONS), 1)
        first = np.cumsum(blocks) - blocks
        number = np.arange(int(blocks.sum()), dtype=np.int64) - np.repeat(first, blocks)
        block_starts = np.repeat(starts, blocks) + number * _POSITIONS
        block_lengths = np.minimum(np.repeat(ends, blocks) - block_starts, _POSITIONS)
        sums = _weighted_sums(data, block_starts, block_lengths)
        later = number > 0
        sums[later] = mix(sums[later] + number[later].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        out = np.add.reduceat(sums, first)
    return mix(out + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _weighted_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum of byte weight times position weight over each run of at most
    ``_POSITIONS`` bytes."""
    first = np.cumsum(lengths) - lengths
    position = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    values = BYTE_WEIGHT[data[position + np.repeat(starts, lengths)]]
    values *= POSITION_WEIGHT[position]
    return np.add.reduceat(values, first)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: every bit of the input reaches every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on (one array, no bounds)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out += words[j : j + n] * POSITION_WEIGHT[j + 17]
    return mix(out)


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts, word ends, and for each text (and one
    past the last) the index of its first word."""
    data = LOWER[data]
    starts, ends = word_runs(data, bounds)
    return data, starts, ends, np.searchsorted(starts, bounds)
