"""Top-k search and the metric range join against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from adrlens.llm import metric_join, topk_search
from adrlens.llm.components import components
from adrlens.llm.queries import QUERIES

from .conftest import VECTORS


def good(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


def best(rows, asks, k):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and good(v)]
    rows = [(i, v) for i, v in rows if all(abs(x) < topk_search.LARGEST for x in v)]
    out = []
    for i, v in dict.fromkeys((i, tuple(v)) for i, v in rows if asks(i)):
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if j != i and len(v) == len(w))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def test_op1_on_hard_rows(spark, hard):
    rows = sorted(tuple(r) for r in QUERIES["op1_topk_search"](spark, hard).collect())
    assert rows == best(VECTORS, lambda i: i % 50 == 0, 5) and rows


def test_many_blocks_and_ties(spark):
    random = np.random.default_rng(3)
    rows = [(i, [float(x) for x in random.integers(-2, 3, 20) / 8]) for i in range(400)]
    found = topk_search.top_k(frame(spark, rows), F.col("vec_id") % 7 == 0, 5, query_block=16, candidate_block=40)
    assert sorted(tuple(r) for r in found.collect()) == best(rows, lambda i: i % 7 == 0, 5)


@settings(max_examples=60, deadline=None)
@given(data=st.data())
def test_branch_and_bound_equals_sorting(data):
    dims, n, k = data.draw(st.integers(1, 20)), data.draw(st.integers(1, 60)), data.draw(st.integers(1, 6))
    random = np.random.default_rng(data.draw(st.integers(0, 1000)))
    queries, columns = random.integers(-9, 10, (3, dims)).astype(float), random.integers(-9, 10, (dims, n)).astype(float)
    ids = random.permutation(n) + 5
    for row, found, scores in topk_search.top_of_block(queries, np.array([5, 6, -1]), columns, ids, k, step=4):
        sums = queries[row] @ columns
        order = [i for i in np.lexsort((ids, -sums)) if ids[i] != (5, 6, -1)[row]][:k]
        assert found.tolist() == ids[order].tolist() and scores.tolist() == sums[order].tolist()


def linked(rows, cosine):
    unit = {}
    for at, (i, v) in enumerate(rows):
        if i is not None and good(v) and any(v):
            w = np.array(v, np.float32).astype(float)
            w /= np.abs(w).max()
            unit[at] = w / np.linalg.norm(w)
    links = {a: [b for b in unit if b != a and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine] for a in unit}
    out = []
    for at, (i, _) in enumerate(rows):
        seen, todo = {at}, [at]
        while todo:
            for b in links.get(todo.pop(), ()):
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        component = i if i is None else min(rows[b][0] for b in seen)
        out.append((i, len(links.get(at, ())), component, component == i))
    return sorted(out, key=repr)


def test_op4_on_hard_rows(spark, hard):
    rows = [tuple(r) for r in QUERIES["op4_metric_range_join"](spark, hard).collect()]
    assert sorted(rows, key=repr) == linked(VECTORS, 0.95)


@pytest.mark.parametrize("cell", [8, 50, 1000])
def test_metric_join_equals_all_pairs(spark, cell):
    random = np.random.default_rng(cell)
    centres = random.normal(size=(12, 6))
    rows = [(i * 3 % 301, [float(np.float32(x)) for x in centres[i % 12] + random.normal(size=6) * 0.2]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(20)] + [(2000 + i, [1.0, 0.5]) for i in range(3)]
    found = metric_join.near_duplicates(frame(spark, rows), 0.95, cell=cell)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == linked(rows, 0.95)


def test_copies_reach_every_neighbour():
    random = np.random.default_rng(1)
    points = metric_join.unit(random.normal(size=(300, 4)))
    pivots, eps = points[:9], math.sqrt(0.1)
    point, cell, home, far = metric_join.assign(points, pivots, eps)
    members = {c: set(point[cell == c]) for c in range(9)}
    homes = dict(zip(point[home], cell[home]))
    assert sorted(homes) == list(range(300)) and len(point) < 300 * 9
    for a, b in zip(*np.nonzero(points @ points.T >= 0.95)):
        assert b in members[homes[a]]


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(1, 2), (2, 3), (9, 8)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
    [(int(a), int(b)) for a, b in np.random.default_rng(5).integers(0, 90, (70, 2))],
])
def test_components(spark, edges):
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    want = sorted((n, root(n)) for n in parent if any(n in e and e[0] != e[1] for e in edges))
    assert sorted(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()) == want
