"""Per-task step of the correlation matrix."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PARTIAL_SCHEMA = (
    "i int, j int, n double, mean_x double, mean_y double, "
    "c_xy double, c_xx double, c_yy double"
)
ROUNDING = 1e-13


def partial_comoments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reduce a task's rows to counts, means and co-moments of each column pair.

    Sums are taken relative to each column's first value; NaN counts as missing.
    """
    shift = sums = None
    for batch in batches:
        values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        if not len(values):
            continue
        present = ~np.isnan(values)
        first = values[present.argmax(axis=0), np.arange(values.shape[1])]
        shift = first if shift is None else np.where(np.isnan(shift), first, shift)
        centred = np.where(present, values - shift, 0.0)
        mask = present.astype(float)
        batch_sums = np.stack(
            [mask.T @ mask, centred.T @ mask, (centred**2).T @ mask, centred.T @ centred]
        )
        sums = batch_sums if sums is None else sums + batch_sums
    if sums is None:
        return
    i, j = np.triu_indices(len(shift))
    both = sums[0][i, j] > 0
    i, j = i[both], j[both]
    n, s_x, s_y = sums[0][i, j], sums[1][i, j], sums[1][j, i]
    yield pa.RecordBatch.from_pydict(
        {
            "i": i.astype("int32"),
            "j": j.astype("int32"),
            "n": n,
            "mean_x": shift[i] + s_x / n,
            "mean_y": shift[j] + s_y / n,
            "c_xy": sums[3][i, j] - s_x * s_y / n,
            "c_xx": _spread(sums[2][i, j], s_x, n),
            "c_yy": _spread(sums[2][j, i], s_y, n),
        }
    )


def _spread(squares: np.ndarray, total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sum of squares around the mean; what is only rounding error becomes 0."""
    around_mean = squares - total * total / n
    return np.where(around_mean <= ROUNDING * squares, 0.0, around_mean)
