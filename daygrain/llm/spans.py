"""Words, hashes and sets of whole Arrow text columns, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The white space that parts words, and odd multipliers of the polynomial hashes.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
FACTOR = 0x9E3779B97F4A7C15
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """FACTOR ** i and FACTOR ** -i modulo 2 ** 64 for i below ``n`` at least."""
    if len(_powers[0]) < n:
        size = 1 << int(n).bit_length()
        for k, base in enumerate((FACTOR, pow(FACTOR, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values: each input bit moves about half of the output bits."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


class Chunk:
    """Consecutive rows of a batch: the bytes of their texts and where each text starts."""

    def __init__(self, first: int, bytes_: np.ndarray, offsets: np.ndarray):
        self.first, self.bytes, self.offsets = first, bytes_, offsets
        self.rows = len(offsets) - 1


def chunks(column: pa.Array, most: int = 1 << 18) -> Iterator[Chunk]:
    """Cut a string column into pieces of whole rows of about ``most`` bytes; null counts as empty.

    A longer row is a piece of its own: what numpy holds at a time is bounded by the piece.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield Chunk(at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        at = to


def word_spans(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each row the number of the first word (one more entry than rows)."""
    inside = ~IS_SPACE[chunk.bytes]
    n = len(inside)
    edges = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, chunk.offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    powers, inverse = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(column: pa.Array, words: int = 5) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles of ``words`` lower-cased words.

    Fewer words make one shingle of them all; no word makes an empty set.
    """
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(FACTOR)) | np.uint64(1)
    for chunk in chunks(column):
        data = LOWER[chunk.bytes]
        starts, ends, first = word_spans(chunk)
        hashes = span_hashes(data, starts, ends)
        rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words if len(rolled) else 0):
            rolled += hashes[k : k + len(rolled)] * factors[k]
        rolled = mixed(rolled)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= words:
                found = np.sort(rolled[a : b - words + 1])
                yield found[np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))]
            elif b > a:
                yield mixed((hashes[a:b] * factors[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)
