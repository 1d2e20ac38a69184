"""Top-k search over large components, against whole numbers."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from adrlens.llm import topk_search

from .test_vectors import frame


def brute(rows, asks, k):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows]
    out = []
    for i, v in whole:
        if asks(i):
            scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in whole if j != i and len(v) == len(w))
            scores = [(s, j) for s, j in scores if -2**63 <= -s < 2**63]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 1e4, 1e6, 1e8, 1e12, 1e30])
def test_large_components_take_part(spark, size):
    random = np.random.default_rng(int(math.log10(size)))
    rows = [(i, [float(np.float32(x)) for x in random.integers(-3, 4, 6) * (size if i % 3 else 1.0)])
            for i in range(90)]
    rows += [(100 + i, rows[1][1]) for i in range(4)]
    found = topk_search.top_k(frame(spark, rows), F.col("vec_id") % 7 == 0, 5, query_block=8, candidate_block=40)
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, lambda i: i % 7 == 0, 5)


def test_scores_that_differ_by_one():
    near = np.array([[2.0 ** 30 + 1, 2.0 ** 30], [2.0 ** 30, 2.0 ** 30], [2.0 ** 30 + 1, 2.0 ** 30 - 1]]).T
    query = np.array([[2.0 ** 30 + 1, 2.0 ** 30]])
    (_, ids, scores), = topk_search.top_of_any(query, np.array([9]), near, np.array([3, 2, 1]), 3)
    q = [2**30 + 1, 2**30]
    want = sorted((-(q[0] * int(a) + q[1] * int(b)), i) for (a, b), i in zip(near.T, (3, 2, 1)))
    assert [(-int(s), int(i)) for s, i in zip(scores, ids)] == want
