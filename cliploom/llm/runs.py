"""Groups of sorted rows inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def group_slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """One batch for each run of equal values of the long ``column``, also where a run crosses batches."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        if held and held[-1].column(column)[-1].as_py() != values[0]:
            yield joined(held)
            held = []
        at = 0
        for cut in cuts.tolist():
            yield joined([*held, batch.slice(at, cut - at)])
            held, at = [], cut
        held.append(batch.slice(at))
    if held:
        yield joined(held)


def joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
