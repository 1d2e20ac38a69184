"""Numeric vectors in Spark rows, used by the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, functions as F


def usable(vector: Column) -> Column:
    """Whether a vector is not null or empty and all its components are finite."""
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (x.cast("double") == low)
                   | (x.cast("double") == high))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(vectors) -> np.ndarray:
    """Rows of equally long vectors as one array of doubles."""
    return np.array([np.asarray(v, np.float64) for v in vectors], np.float64)
