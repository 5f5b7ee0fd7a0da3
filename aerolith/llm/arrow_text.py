"""Reading texts out of Arrow batches in slices of bounded size, and arrays as compressed bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard


def utf8_slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, offsets) for runs of rows of about limit bytes, one row at least; null is empty.

    offsets has a value more than there are rows and starts at 0.
    """
    if not batch.num_rows:
        return
    col = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
    _, offset_buffer, data_buffer = col.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None and data_buffer.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(col):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def squeezed(a: np.ndarray) -> bytes:
    """An array as compressed bytes, the bytes of equal place in its numbers side by side."""
    a = np.ascontiguousarray(a)
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if len(a) else b"")


def loosened(x: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1) if len(raw) else np.zeros(0, kind)
