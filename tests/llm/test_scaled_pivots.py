"""The metric range join where points are scaled copies of each other."""

from __future__ import annotations

import math

import numpy as np
import pytest

from adrlens.llm import metric_join

from .test_vectors import frame, linked


def test_copies_cross_cells_of_one_direction():
    random = np.random.default_rng(0)
    pivot = random.normal(size=64).astype(np.float32)
    points = metric_join.unit(np.float64(pivot + random.normal(size=(300, 64)).astype(np.float32) * 0.05))
    pivots = metric_join.unit(np.float64([pivot, np.float32(7) * pivot]))
    point, cell, home, _ = metric_join.assign(points, pivots, math.sqrt(0.1))
    members, homes = {c: set(point[cell == c]) for c in (0, 1)}, dict(zip(point[home], cell[home]))
    assert (points @ points.T >= 0.95).all()
    assert all(members[homes[a]] == set(range(300)) for a in range(300))


def test_one_pivot_per_direction():
    pivots = [[1.0, 2.0], [3.0, 6.0], [2.0, 1.0], [1.0, 2.0, 0.0], [7.0, 14.0]]
    assert metric_join.distinct(pivots) == [[1.0, 2.0], [2.0, 1.0], [1.0, 2.0, 0.0]]


@pytest.mark.parametrize("cell", [4, 30])
def test_scaled_copies_equal_all_pairs(spark, cell):
    random = np.random.default_rng(cell)
    base = random.normal(size=(4, 16)).astype(np.float32)
    rows = [(i, [float(x) for x in base[i % 4] * np.float32(1 + i)]) for i in range(100)]
    rows += [(100 + i, [float(np.float32(x)) for x in base[i % 4] + random.normal(size=16) * 0.1]) for i in range(100)]
    found = metric_join.near_duplicates(frame(spark, rows), 0.95, cell=cell)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == linked(rows, 0.95)
