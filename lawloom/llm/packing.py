"""Arrays of numbers as compressed cells of a DataFrame."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Numbers as bytes, most significant ones apart, compressed; bytes that never differ are held once."""
    width = values.dtype.itemsize
    values = np.ascontiguousarray(values)
    flat = values.view(f"u{width}").ravel()
    differ = int(np.bitwise_or.reduce(flat ^ flat[0])) if len(flat) else 0
    held = [k for k in range(width) if differ >> 8 * k & 255]
    planes = values.view(np.uint8).reshape(-1, width)
    body = [np.array([len(flat)], dtype=np.uint64).tobytes(), flat[:1].tobytes(), *(planes[:, k].tobytes() for k in held)]
    return bytes([width, sum(1 << k for k in held)]) + zstandard.compress(b"".join(body), 1)


def unpack(blob: bytes) -> np.ndarray:
    """The packed numbers, unsigned."""
    width, body = blob[0], np.frombuffer(zstandard.decompress(blob[2:]), dtype=np.uint8)
    n = int(body[:8].view(np.uint64)[0])
    kind = np.dtype(f"u{width}")
    if not n:
        return np.zeros(0, dtype=kind)
    held = [k for k in range(width) if blob[1] >> k & 1]
    values = np.full(n, body[8 : 8 + width].copy().view(kind)[0])
    planes = values.view(np.uint8).reshape(-1, width)
    for k, plane in zip(held, body[8 + width :].reshape(len(held), n), strict=True):
        planes[:, k] = plane
    return values


def join_packed(column) -> np.ndarray:
    """The numbers of all cells, one after the other."""
    return np.concatenate([unpack(b.as_py()) for b in column])


def schema_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def to_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """A batch of (text, number, blob ...) rows."""
    types = [pa.string(), pa.int64(), *[pa.binary()] * (len(names) - 2)]
    return schema_batch(rows, pa.schema(list(zip(names, types, strict=True))))


def runs(sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of equal keys."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))
    return starts, np.append(starts[1:], len(sorted_keys))
