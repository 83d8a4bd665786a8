"""Groups of sorted rows across the borders of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """Rows of integer columns, sorted by the first ``keys``, in arrays that never end inside a group.

    What is held is one batch and one group.
    """
    rest: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
        same = (rows[:, :keys] == rows[-1, :keys]).all(axis=1)
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut or (rest and (rest[-1][-1, :keys] != rows[0, :keys]).any()):
            if cut == 0:  # the batch is one group, and not the one that was held
                yield np.concatenate(rest)
                rest = [rows]
                continue
            yield np.concatenate([*rest, rows[:cut]])
            rest = [rows[cut:]]
        else:
            rest.append(rows)
    if rest:
        yield np.concatenate(rest)


def group_bounds(rows: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each group."""
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(rows)))
