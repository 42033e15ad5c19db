"""Embedding vectors as exact whole numbers, for the operators that compare them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A component becomes floor(SCALE * x).
SCALE = 256
# Components beyond this are refused: sums of products of such numbers stay exact in 64 bits.
LARGEST = 1 << 26


def whole_numbers(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The usable vectors of a column of lists: (row numbers, matrix of integers, their lengths).

    Usable are vectors that are not null and have no null, NaN or infinite component, with ``width`` exactly that many
    components. Shorter vectors of a matrix are filled up with zeros. A component beyond ``LARGEST`` raises ``ValueError``.
    """
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows, parts, sizes = [], [], []
    for n in np.unique(lengths):
        if n < 0 or (width is not None and n != width):
            continue
        at = np.flatnonzero(lengths == n)
        flat = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), n)
        fine = np.isfinite(flat).all(axis=1)
        whole = np.floor(flat[fine] * SCALE)
        if whole.size and np.abs(whole).max() > LARGEST:
            raise ValueError(f"a component beyond {LARGEST / SCALE:.0f}: its products would not be exact")
        rows.append(at[fine])
        parts.append(whole.astype(np.int64))
        sizes.append(np.full(int(fine.sum()), n))
    if not rows:
        return np.zeros(0, np.int64), np.zeros((0, width or 0), np.int64), np.zeros(0, np.int64)
    wide = max(p.shape[1] for p in parts)
    matrix = np.concatenate([np.pad(p, ((0, 0), (0, wide - p.shape[1]))) for p in parts])
    where = np.concatenate(rows)
    order = np.argsort(where)
    return where[order], matrix[order], np.concatenate(sizes)[order]
