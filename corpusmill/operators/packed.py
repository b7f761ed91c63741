"""Arrays of a batch packed to one body, and hashes dealt by range."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(planes: list[np.ndarray]) -> tuple[int, bytes]:
    """Arrays as one compressed body, their bytes by place; its size before that."""
    body = b"".join(np.array([len(x)], np.int64).tobytes() + np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes() for x in planes)
    return len(body), pa.Codec("zstd", 3).compress(body, asbytes=True)


def unpacked(body: bytes, size: int, kinds: list[type]) -> list[np.ndarray]:
    raw = pa.Codec("zstd").decompress(body, size, asbytes=True)
    at, out = 0, []
    for kind in kinds:
        n, width = int(np.frombuffer(raw, np.int64, 1, at)[0]), np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * width, at + 8).reshape(width, n).T).view(kind).reshape(n))
        at += 8 + n * width
    return out


def ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Of n ranges of 64-bit hashes, those of the keys, ascending with them."""
    return (((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of each run of equal keys, none of which is below 0."""
    edges = [*np.flatnonzero(np.diff(keys, prepend=-1)), len(keys)]
    return list(zip(edges[:-1], edges[1:], strict=True))
