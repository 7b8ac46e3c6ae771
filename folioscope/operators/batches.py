"""Pieces of Arrow batches, so that what a map holds at once is bounded by bytes of text, not by rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that a map takes at once.
PIECE = 2 << 20


def pieces(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, in slices of at most ``most`` bytes of a text column, or of one longer row; no copies."""
    most = PIECE if most is None else most
    upto = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), np.int64))
    first = 0
    while first < batch.num_rows:
        before = int(upto[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + most, "right")))
        yield batch.slice(first, last - first)
        first = last
