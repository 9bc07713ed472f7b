"""Sorted keys and small numbers as compressed bytes, so that tasks exchange arrays instead of rows."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa

_CODEC = pa.Codec("zstd", compression_level=1)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers or floats; sorted integers are kept as differences, bytes of equal weight lie together."""
    out = io.BytesIO()
    for values in arrays:
        kind = values.dtype
        rising = kind.kind == "u" and len(values) > 1 and bool((values[1:] >= values[:-1]).all())
        data = np.diff(values, prepend=values.dtype.type(0)) if rising else values
        planes = np.ascontiguousarray(np.frombuffer(data.tobytes(), np.uint8).reshape(-1, kind.itemsize).T).tobytes()
        body = _CODEC.compress(planes, asbytes=True)
        out.write(np.array([len(values), len(body), rising], np.int64).tobytes())
        out.write(kind.str.encode().ljust(8))
        out.write(body)
    return out.getvalue()


def unpacked(data: bytes) -> list[np.ndarray]:
    found, at = [], 0
    while at < len(data):
        n, size, rising = np.frombuffer(data, np.int64, 3, at)
        kind = np.dtype(data[at + 24 : at + 32].decode().strip())
        body = data[at + 32 : at + 32 + size]
        planes = _CODEC.decompress(body, decompressed_size=int(n) * kind.itemsize, asbytes=True) if n else b""
        values = np.frombuffer(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, -1).T).tobytes(), kind)
        found.append(np.cumsum(values, dtype=kind) if rising else values)
        at += 32 + int(size)
    return found


def summed(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and sums of the values by key."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], *(np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values)
