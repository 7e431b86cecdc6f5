"""Arrow batches in parts of bounded size, so that a task's memory doesn't depend on the length of texts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PART_BYTES = 3_000_000


def parts(batches: Iterable[pa.RecordBatch], column: int | str, size: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of about ``size`` bytes of a text column, of one row at least; empty batches are left out."""
    for batch in batches:
        place = batch.schema.get_field_index(column) if isinstance(column, str) else column
        lengths = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_numpy()
        bounds = np.flatnonzero(np.diff(lengths.cumsum(dtype=np.int64) // size)) + 1
        for start, end in zip([0, *bounds.tolist()], [*bounds.tolist(), batch.num_rows]):
            if end > start:
                yield batch.slice(start, end - start)
