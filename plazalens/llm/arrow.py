"""Texts of Arrow batches as bytes, and their words as numbers: whole batches at a time, no loop over words."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20  # what is worked on at once; a longer text is a chunk of its own
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_CODES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over the whole word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Chunk:
    """Rows ``first`` to ``last`` of a batch; ``data`` their bytes one after another, ``ends[i]:ends[i + 1]`` those of row i."""

    def __init__(self, first: int, last: int, data: np.ndarray, ends: np.ndarray):
        self.first, self.last, self.data, self.ends = first, last, data, ends

    def __len__(self) -> int:
        return self.last - self.first

    def words(self, separator: np.ndarray = WHITE, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words (maximal runs without a byte of ``separator``) and where each row's begin, one more for the end."""
        starts, stops, bounds, inside = self.spans(separator)
        if not len(starts):
            return np.zeros(0, np.uint64), bounds
        data = (LOWERED[self.data] if lower else self.data)[inside]
        lengths = stops - starts
        begin = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(len(data)) - np.repeat(begin, lengths)
        sums = np.add.reduceat(BYTE_CODES[data] * powers(int(lengths.max()))[place], begin)
        return mixed(sums + lengths.astype(np.uint64)), bounds

    def spans(self, separator: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words in bytes, where each row's words begin, and which bytes are in words."""
        inside = ~separator[self.data]
        n = len(inside)
        first, last = np.ones(n, bool), np.ones(n, bool)
        first[1:], last[:-1] = ~inside[:-1], ~inside[1:]
        first[self.ends[:-1][self.ends[:-1] < n]] = True
        last[self.ends[1:][self.ends[1:] > 0] - 1] = True
        starts, stops = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
        return starts, stops, np.searchsorted(starts, self.ends), inside


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column with empty text for null."""
    return batch.column(name).cast(pa.large_string()).fill_null("")


def chunks(column: pa.Array, size: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """All rows of a text column, in order."""
    if not len(column):
        return
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + size, "right")) - 1)
        last = min(last, len(column))
        yield Chunk(first, last, data[ends[first] : ends[last]], ends[first : last + 1] - ends[first])
        first = last


def grams(words: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``n`` consecutive words of one row, and where each row's begin. A row of fewer words has none."""
    counts = np.maximum(np.diff(bounds) - n + 1, 0)
    begins = np.concatenate(([0], np.cumsum(counts)))
    if not begins[-1]:
        return np.zeros(0, np.uint64), begins
    at = np.repeat(bounds[:-1] - begins[:-1], counts) + np.arange(begins[-1])
    out = np.zeros(len(at), np.uint64)
    for j in range(n):
        out += words[at + j] * PLACE_CODES[j]
    return mixed(out), begins
