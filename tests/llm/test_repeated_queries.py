"""Top-k search where query rows are repeated."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from adrlens.llm import topk_search

from .test_vectors import best, frame


def test_repeated_query_keeps_all_ranks(spark):
    random = np.random.default_rng(2)
    rows = [(i, [float(x) for x in random.integers(-9, 10, 8) / 8]) for i in range(60)]
    rows += [rows[0], rows[0], rows[50], (50, rows[1][1])]  # copies of queries, and another vector of one
    found = topk_search.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, 5, query_block=2, candidate_block=16)
    found = sorted(tuple(r) for r in found.collect())
    assert found == best(rows, lambda i: i % 50 == 0, 5)
    assert [r[1] for r in found if r[0] == 0] == [1, 2, 3, 4, 5] and len(found) == 15
