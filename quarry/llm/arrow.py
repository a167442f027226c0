"""Arrow batches in small pieces, so that a task's memory follows the longest
text rather than the batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes in ``column`` each (one
    row at least)."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = used = 0
        for i, n in enumerate(sizes):
            if used and used + n > limit:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += n + 64
        if start < batch.num_rows:
            yield batch.slice(start)
