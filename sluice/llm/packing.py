"""Arrays of whole numbers packed into binary columns, for rows that hold a block or a shard of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0, as byte planes without those that are zero, compressed."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + squeeze(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(unsqueeze(data[1:]), np.uint8).reshape(width, -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, :width] = planes.T
    return values.view("<u8").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending numbers by their differences."""
    return pack(np.diff(values.astype(np.uint64), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def rows_of(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The values of each row, one row's at a time: packed values are large."""
    for i in range(batch.num_rows):
        yield tuple(batch.column(name)[i].as_py() for name in names)
