"""Arrow string columns as flat byte buffers, cut into pieces of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def pieces(column: pa.Array, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows of about ``most`` bytes: (first row, end row, bytes, offsets from 0).

    A single longer text is a piece of its own.
    """
    data, offsets = flat_bytes(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        end = min(end, n)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, byte by byte."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_SALT = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def distinct_words(data: np.ndarray, offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """(words as binary, how often) for white-space separated words, over cuts of about ``most`` bytes.

    A word may come up again in a later cut. Words are told apart by 64-bit hashes within a cut.
    """
    space = _SPACE[data]
    # a word ends where white space or the next text begins
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    word = ~space
    begins = np.flatnonzero(word & (np.concatenate([[True], space[:-1]]) | edge[:-1])) if len(data) else np.zeros(0, np.int64)
    if not len(begins):
        return
    following = np.concatenate([begins[1:], [len(data)]])
    at = 0
    while at < len(begins):
        to = max(at + 1, int(np.searchsorted(begins, begins[at] + most)))
        lo, hi = begins[at], following[to - 1]
        own = np.flatnonzero(word[lo:hi])
        starts = np.searchsorted(own, begins[at:to] - lo)
        lengths = np.diff(np.concatenate([starts, [len(own)]]))
        powers = _powers(int(lengths.max()))
        within = np.arange(len(own)) - np.repeat(starts, lengths)
        hashes = np.add.reduceat(_SALT[data[lo:hi][own]] * powers[within], starts)
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
        counts = np.diff(np.concatenate([first, [len(order)]]))
        pick = order[first]
        sizes = lengths[pick]
        ends = np.cumsum(sizes)
        source = np.arange(int(ends[-1])) + np.repeat(begins[at:to][pick] - (ends - sizes), sizes)
        raw = data[source]
        where = np.concatenate([[0], ends]).astype(np.int32)
        yield pa.Array.from_buffers(pa.binary(), len(pick), [None, pa.py_buffer(where), pa.py_buffer(raw)]), counts
        at = to
