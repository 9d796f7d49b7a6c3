"""Arrays of numbers as compressed bytes, for rows that carry many of them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray, rising: bool = False) -> bytes:
    """Bytes of an integer or float array; ``rising`` values of uint64 are stored as differences."""
    if rising and len(values):
        values = np.concatenate([values[:1], np.diff(values)])
    if values.dtype.kind in "iu" and len(values):
        top = int(values.max())
        for kind in (np.uint8, np.uint16, np.uint32):
            if top <= np.iinfo(kind).max:
                values = values.astype(kind)
                break
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T) if len(values) else values
    body = pa.compress(planes.tobytes(), codec="zstd", asbytes=True)
    return values.dtype.str.encode().ljust(4) + len(values).to_bytes(8, "little") + body


def unpack(data: bytes, rising: bool = False, kind: type | None = None) -> np.ndarray:
    """The array that ``pack`` was given, as ``kind`` if given."""
    dtype, n = np.dtype(data[:4].strip().decode()), int.from_bytes(data[4:12], "little")
    raw = pa.decompress(data[12:], decompressed_size=n * dtype.itemsize, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(dtype.itemsize, n)
    values = np.ascontiguousarray(planes.T).view(dtype).reshape(n)
    if rising:
        return np.cumsum(values.astype(np.uint64), dtype=np.uint64)
    return values.astype(kind) if kind else values
