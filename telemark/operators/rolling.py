"""Quantiles over trailing time windows of Arrow groups, in one pass per group.

Spark's own percentile over a moving frame sorts the frame again for every row, which is
quadratic in the rows per frame. Here the frame moves through a sorted structure (pandas'
rolling quantile over given bounds), at a logarithmic cost per row.
"""
from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer


class Bounds(BaseIndexer):
    """Windows given as positions: row i sees `first[i]` up to before `last[i]`."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        return self.first, self.last


def series_codes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """A number per distinct key, NULL being a key of its own."""
    codes = np.zeros(table.num_rows, dtype=np.int64)
    for name in keys:
        column = table[name].combine_chunks().dictionary_encode(null_encoding="encode")
        mixed = codes * max(len(column.dictionary), 1) + column.indices.to_numpy(zero_copy_only=False)
        codes = np.unique(mixed, return_inverse=True)[1].astype(np.int64)
    return codes


def trailing_quantiles(
    keys: list[str], width: int, wanted: dict[str, float], value: str = "_v", at: str = "_t",
) -> Callable[[pa.Table], pa.Table]:
    """A function that adds quantiles of each row's series over the last `width` units of `at`.

    Row and peers of the same time are in their window, as is what is exactly `width` old.
    Quantiles interpolate as Spark's percentile does: NULL values do not count, NaN is the
    largest value, and a window without values gives NULL. Rows without a time see each other.
    """
    def add(table: pa.Table) -> pa.Table:
        codes = series_codes(table, keys)
        times = table[at].fill_null(0).to_numpy()
        begin = times.min() if len(times) else 0
        # One axis: series after series, further apart than a window.
        axis = codes * (int(np.ptp(times)) + width + 1 if len(times) else 1) + (times - begin)
        order = np.argsort(axis, kind="stable")
        axis = axis[order]
        bounds = Bounds(first=np.searchsorted(axis, axis - width, "left"),
                        last=np.searchsorted(axis, axis, "right"))
        there = table[value].is_valid().to_numpy()[order]
        values = table[value].fill_null(0.0).to_numpy()[order]
        # Ranks move through the windows, so that NaN and infinities are values like others.
        known, ranks = np.unique(values, return_inverse=True)
        rolling = pd.Series(np.where(there, ranks, np.nan)).rolling(bounds, min_periods=1)
        seen = np.concatenate([[0], np.cumsum(there)])
        n = seen[bounds.last] - seen[bounds.first]
        for name, p in wanted.items():
            low, high = (rolling.quantile(p, interpolation=side).fillna(0).to_numpy().astype(np.int64)
                         for side in ("lower", "higher"))
            part = (n - 1) * p - np.floor((n - 1) * p)
            with np.errstate(invalid="ignore"):
                found = np.where(low == high, known[low], (1 - part) * known[low] + part * known[high])
            out = np.empty(len(found))
            out[order] = found
            empty = np.empty(len(found), dtype=bool)
            empty[order] = n == 0
            table = table.append_column(name, pa.array(out, pa.float64(), mask=empty))
        return table

    return add
