"""Texts in Arrow batches, taken in slices of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

SLICE_CHARS = 4_000_000


def slices(batch: pa.RecordBatch, column: str, chars: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with at most ``chars`` characters each, one row at least.

    For a binary column these are bytes.
    """
    values = batch.column(column)
    length = pc.utf8_length if pa.types.is_string(values.type) or pa.types.is_large_string(values.type) else pc.binary_length
    lengths = pc.fill_null(length(values), 0).to_numpy(zero_copy_only=False)
    start = total = 0
    for row, length in enumerate(lengths):
        if row > start and total + length > chars:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += int(length)
    if batch.num_rows > start:
        yield batch.slice(start)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [text or "" for text in batch.column(column).to_pylist()]
