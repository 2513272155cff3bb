"""Runs of equal keys in sorted Arrow columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def run_starts(*columns: pa.Array) -> np.ndarray:
    """Where runs of equal keys begin; NULLs are equal, and so are NaNs."""
    differ = np.zeros(max(0, len(columns[0]) - 1), bool)
    for keys in columns:
        a, b = keys[1:], keys[:-1]
        if pa.types.is_nested(keys.type):
            own = keys.to_pylist()
            differ |= np.array([x != y for x, y in zip(own[1:], own, strict=False)], bool)
            continue
        same = pc.and_(pc.is_null(a), pc.is_null(b))
        if pa.types.is_floating(keys.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
        unlike = pc.fill_null(pc.not_equal(a, b), True)
        differ |= pc.and_(unlike, pc.invert(same)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(differ) + 1])


def same_key(a: list[pa.Array], b: list[pa.Array]) -> bool:
    """Whether two keys, each a list of columns of one row, are equal."""
    return all(len(run_starts(pa.concat_arrays([x, y]))) == 1 for x, y in zip(a, b, strict=True))
