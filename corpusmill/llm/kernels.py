"""Numpy kernels over UTF-8 bytes: words, word hashes, shingles. No per-character Python."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

K1 = np.uint64(0x9E3779B97F4A7C15)
K2 = np.uint64(0xBF58476D1CE4E5B9)
K3 = np.uint64(0x94D049BB133111EB)
#: Bytes of text that a kernel call works on at once; bounds a Python worker's memory.
SLICE_BYTES = 4 << 20


def release() -> None:
    """Give memory that is free back to the system. Python workers live on from stage to stage, and what one stage's arrays have
    taken would else be kept beside the next one's."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every system's library has it
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * K2
        x = (x ^ (x >> np.uint64(27))) * K3
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that `column` has at most `limit` bytes in each, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start, base = 0, 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start, base = stop, int(ends[stop - 1])


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its n + 1 offsets; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1 + column.offset)[column.offset :]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[off[0] : off[-1]], off - off[0]


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return buf + (((buf >= 65) & (buf <= 90)).astype(np.uint8) << 5)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and segment of each word `[^ \\t-\\r]+`; segments are cut at `off`."""
    if not len(buf):
        e = np.zeros(0, np.int64)
        return e, e, e
    inside = ~((buf == 32) | ((buf >= 9) & (buf <= 13)))
    first = np.empty(len(buf), bool)
    first[0], first[1:] = True, ~inside[:-1]
    cuts = off[:-1][off[:-1] < off[1:]]
    first[cuts] = True
    last = np.empty(len(buf), bool)
    last[-1], last[:-1] = True, ~inside[1:]
    last[off[1:][off[:-1] < off[1:]] - 1] = True
    starts, ends = np.flatnonzero(inside & first), np.flatnonzero(inside & last) + 1
    return starts, ends, np.repeat(np.arange(len(off) - 1), np.diff(np.searchsorted(starts, off)))


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, eight bytes at a time for all spans together."""
    size = (ends - starts).astype(np.int64)
    h = mix(size.astype(np.uint64) * K1 + K3)
    if not len(starts):
        return h
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    words_at = np.ndarray(len(padded) - 7, np.uint64, padded, strides=(1,))  # the eight bytes from each place on
    masks = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)
    live, at, left = slice(None), starts, size
    with np.errstate(over="ignore"):
        while len(at):
            h[live] = mix((h[live] ^ (words_at[at] & masks[np.minimum(left, 8)])) * K1 + K2)
            more = np.flatnonzero(left > 8)
            live = more if isinstance(live, slice) else live[more]
            at, left = at[more] + 8, left[more] - 8
    return h


def shingles(h: np.ndarray, seg: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two independent hashes and the segment of each run of `k` words in a segment; a segment of fewer words gives one run,
    its whole sequence."""
    n = len(h)
    empty = np.zeros(0, np.uint64)
    outs, others, segs = [empty], [empty], [np.zeros(0, np.int64)]

    def add(at: np.ndarray, c: int) -> None:
        for out, factor in ((outs, K2), (others, K3)):
            s = h[: n - c + 1].copy()
            for j in range(1, c):
                s *= factor
                s += h[j : n - c + 1 + j]
            out.append(mix(s[at] + np.uint64(c)))
        segs.append(seg[at])

    with np.errstate(over="ignore"):
        if n >= k:
            add(np.flatnonzero(seg[: n - k + 1] == seg[k - 1 :]), k)
        first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])) if n else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([first, [n]]))
        for c in range(1, k):
            at = first[count == c]
            if len(at):
                add(at, c)
    return np.concatenate(outs), np.concatenate(others), np.concatenate(segs)


def stable_order(key: np.ndarray) -> np.ndarray:
    """The places of non-negative integers in ascending order, ties in their own: one plain sort of key and place together
    where both fit 64 bits."""
    bits = max(1, int(len(key)).bit_length())
    if not len(key) or int(key.max()) >> (64 - bits):
        return np.argsort(key, kind="stable")
    both = (key.astype(np.uint64) << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64)
    both.sort()
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for `counts` items of each range, one after the other."""
    counts = np.asarray(counts, np.int64)
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(np.asarray(starts, np.int64), counts)


def spans(starts: np.ndarray, end: int) -> Iterator[tuple[int, int]]:
    """Start and end of each run, given where runs start and where the last one ends; none for no runs."""
    edges = [*map(int, starts), end]
    return zip(edges[:-1], edges[1:], strict=True)
