"""Whole Arrow batches of text as arrays of words and hashes, without a loop over words.

All helpers here work on one slice of a batch (``slices``), so memory in a Python worker is bounded
by the slice size and the longest single text. White space is ``[\\x20\\x09-\\x0D]`` throughout, which
is ASCII and so can be found in the UTF-8 bytes directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
NULL_ID = np.iinfo(np.int64).min

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed one-to-one map)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, up to exponent n."""
    if len(_powers["up"]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.full(size, base & _MASK, np.uint64)
            table[0] = 1
            _powers[name] = np.multiply.accumulate(table)
    return _powers["up"], _powers["down"]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of about ``limit`` bytes of text; a longer text is a piece alone."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes.astype(np.int64) + 16)
    begin = 0
    while begin < batch.num_rows:
        used = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, used + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (n + 1 offsets). Null: empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids(column: pa.Array) -> np.ndarray:
    """Ids as int64; null becomes the smallest value."""
    return pc.fill_null(column.cast(pa.int64()), int(NULL_ID)).to_numpy(zero_copy_only=False)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word in the bytes, and the first word of each text (n + 1 values)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    after = edge[:-1].copy()
    after[1:] |= space[:-1]
    before = edge[1:].copy()
    before[:-1] |= space[1:]
    starts = np.flatnonzero(~space & after)
    ends = np.flatnonzero(~space & before) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, from one running sum over all of them."""
    up, down = _tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix64(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def run_hash(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive hashes; run i begins at value i."""
    out = np.zeros(max(0, len(values) - n + 1), np.uint64)
    for j in range(n):
        out *= np.uint64(0xA0761D6478BD642F)
        out += values[j : j + len(out)]
    return mix64(out)


def run_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a run of n words fits within one text, and the text of each position."""
    count = np.maximum(np.diff(first) - n + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    begin = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(count)[:-1])), count)
    return begin + np.arange(len(text)), text


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
