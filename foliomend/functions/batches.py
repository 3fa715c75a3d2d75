"""Arrow batches in slices. A batch has thousands of rows, and what Python makes of a text is many times as large."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute


def text_bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of each text, or of each list of texts; null has none."""
    if pa.types.is_list(texts.type) or pa.types.is_large_list(texts.type):
        own = np.concatenate([[0], np.cumsum(text_bytes(texts.flatten()))])
        counts = pyarrow.compute.fill_null(pyarrow.compute.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
        return np.diff(own[np.concatenate([[0], np.cumsum(counts)])])
    return pyarrow.compute.fill_null(pyarrow.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)


def cuts(texts: pa.Array, most: int = 1 << 20, rows: int = 1024) -> Iterator[tuple[int, int]]:
    """(first, number): slices of at most `rows` texts that have at most `most` bytes together, or of one that is longer."""
    size = np.cumsum(text_bytes(texts))
    at = 0
    while at < len(size):
        end = int(np.searchsorted(size, (size[at - 1] if at else 0) + most, "right"))
        end = min(max(at + 1, end), at + rows)
        yield at, end - at
        at = end


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """Batches in slices by the texts of a column. An empty batch has none."""
    for batch in batches:
        for at, n in cuts(batch.column(column)):
            yield batch.slice(at, n)
