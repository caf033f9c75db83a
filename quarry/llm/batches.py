"""Groups of rows in sorted Arrow batches."""

from __future__ import annotations

import numpy as np


def by_key(batches, names):
    """(key, list of batches) of the rows that are equal in the integer
    columns ``names``; the batches are sorted by them."""
    held, last = [], None
    for batch in batches:
        key = np.stack([batch.column(k).to_numpy() for k in names], axis=1)
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(key)], strict=True):
            if hi > lo:
                if last is not None and (key[lo] != last).any():
                    yield last, held
                    held = []
                last = key[lo]
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield last, held
