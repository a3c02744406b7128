"""Texts of an Arrow column as one byte array: splitting and hashing without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are worked on at a time. One longer text is worked on alone, whole. Intermediates have 8 bytes a
#: byte or more, and freed ones stay with the worker.
SLICE_BYTES = 512 << 10
#: Bytes whose hashes are computed at a time, which bounds the 8-byte intermediates.
BLOCK_BYTES = 256 << 10

#: ASCII white space: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

BASE = np.uint64(0x9E3779B97F4A7C15)
_weights = np.ones(0, np.uint64)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The column in order, cut between rows so that each part has about `limit` text bytes."""
    _, offsets = text_bytes(column)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield column.slice(at, end - at)
        at = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all texts, where each begins; one more offset ends the last). Null: empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    places = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[places[0] : places[-1]], places - places[0]


def runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the longest runs of member bytes; no run crosses from text to text."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = inside[:-1] & (~inside[1:] | edge[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends)


def weights(n: int) -> np.ndarray:
    """Odd numbers without a pattern, one for each place in a range. Powers of a number would not do: modulo 2^64,
    whole families of strings, like the Thue-Morse word and its complement, have equal sums."""
    global _weights
    if len(_weights) < n:
        places = np.arange(1 << int(n).bit_length(), dtype=np.uint64)
        _weights = mixed(mixed(places * BASE) + BASE) | np.uint64(1)
    return _weights


def mixed(h: np.ndarray) -> np.ndarray:
    """The bits of each number spread over all 64."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each range. Ranges ascend and don't overlap."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    full = np.flatnonzero(lengths > 0)
    if len(full):
        weight = weights(int(lengths.max()))
    total = np.cumsum(lengths[full])
    at = 0
    while at < len(full):
        before = total[at - 1] if at else 0
        end = max(int(np.searchsorted(total, before + BLOCK_BYTES, "right")), at + 1)
        part = full[at:end]
        n = lengths[part]
        first = np.cumsum(n) - n
        index = np.arange(int(n.sum()))
        place = index - np.repeat(first, n)
        values = data[place + np.repeat(starts[part], n)].astype(np.uint64)
        values += np.uint64(1)
        values *= weight[place]
        out[part] = np.add.reduceat(values, first)
        at = end
    return mixed(out + lengths.astype(np.uint64))


def expanded(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (count numbers) of each range, one after the other."""
    first = np.cumsum(counts) - counts
    return np.arange(int(counts.sum())) + np.repeat(starts - first, counts)


def owners(offsets: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The text that each place lies in."""
    return np.searchsorted(offsets, places, "right") - 1


def sums(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The sum of the values of each owner 0 to n - 1, as whole numbers."""
    total = np.concatenate([[0], np.cumsum(values.astype(np.int64))])
    ends = np.searchsorted(owner, np.arange(n), "right")
    starts = np.searchsorted(owner, np.arange(n), "left")
    return total[ends] - total[starts]
