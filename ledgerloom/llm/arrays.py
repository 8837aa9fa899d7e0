"""Vectorised helpers over Arrow string columns: bytes, words and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on at a time; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 20


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The column as 64-bit offset strings, null as the empty text."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_string()).fill_null("")


def offsets_and_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets from 0 and the UTF-8 bytes of a large_string array without nulls."""
    _, at, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    body = np.frombuffer(data, np.uint8)[low:high] if data is not None else np.zeros(0, np.uint8)
    return offsets - low, body


def slices(batch: pa.RecordBatch, name: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``most`` text bytes, or one row."""
    if batch.num_rows == 0:
        return
    column = batch.column(batch.schema.get_field_index(name))
    wide = pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()
    offsets, _ = offsets_and_bytes(column.cast(wide).fill_null(b"" if wide == pa.large_binary() else ""))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high
    pa.default_memory_pool().release_unused()  # else a worker that is used again keeps its largest batch's memory


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** n, modulo 2 ** 64."""
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """sums[i] = sum of (data[j] + 1) * BASE ** j for j < i: any substring's hash is a difference of two."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data))[: len(data)], out=out[1:])
    return out


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, unshift: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends]; ``unshift`` is powers(INVERSE, len(data))."""
    return mix64((sums[ends] - sums[starts]) * unshift[starts])


_BLOCK = 1 << 20


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[starts:ends] for spans in order that don't overlap, about a megabyte of data at a time."""
    out, low = np.empty(len(starts), np.uint64), 0
    unshift = powers(INVERSE, min(_BLOCK, len(data)))
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(ends, starts[low] + _BLOCK, "right")))
        first, last = int(starts[low]), int(ends[high - 1])
        own = unshift if last - first < len(unshift) else powers(INVERSE, last - first)
        out[low:high] = substring_hashes(prefix_sums(data[first:last]), starts[low:high] - first, ends[low:high] - first, own)
        low = high
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def spaced_words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cases A-Z and puts one space after each word of ``[^\\x20\\x09-\\x0D]+``, also after a text's last.

    Returns the new bytes, each word's start and end in them, and each text's first word (with the total at the end).
    """
    n = len(offsets) - 1
    space = _SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(~space & (first[:-1] | np.concatenate(([True], space[:-1]))))
    after = np.ones(len(data) + 1, bool)
    after[:-1] = space
    ends = np.flatnonzero((after | first)[1:] & ~space) + 1
    words = np.searchsorted(starts, offsets[: n + 1], "left")
    lengths = ends - starts
    new_starts = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths + 1, out=new_starts[1:])
    out = np.full(int(new_starts[-1]), 0x20, np.uint8)
    letters = np.ones(len(out), bool)
    letters[new_starts[1:] - 1] = False
    out[letters] = _LOWER[data[~space]]
    return out, new_starts[:-1], new_starts[1:] - 1, words
