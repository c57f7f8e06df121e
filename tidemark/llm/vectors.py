"""What the operators on vectors share: usable rows, packs of rows, angles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for vectors without null or non-finite components; null and empty ones are not usable."""
    column = F.col(f"`{vector}`")
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(column) > 0) & finite, F.lit(False))


def matrix(values, width: int) -> np.ndarray:
    """Rows of an Arrow list column without nulls, all of one length, as doubles."""
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, width)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero. No square over- or underflows."""
    largest = np.abs(rows).max(axis=1, keepdims=True, initial=0.0)
    scaled = rows / np.where(largest > 0, largest, 1.0)
    length = np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
    return scaled / np.where(length > 0, length, 1.0)


def by_width(lengths: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each vector length with the places of its rows."""
    for width in np.unique(lengths).tolist():
        yield width, np.flatnonzero(lengths == width)
