from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from adrlens.llm import ranked_search
from adrlens.llm.queries import QUERIES
from adrlens.llm.sql import ORACLE_SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = {c: c + 32 for c in range(65, 91)}
    return [t.translate(lower) for t in TERM.findall(text or "")]


def brute_force(docs, items, k):
    """All scores, term by term."""
    cut = [(id_, Counter(terms(text))) for id_, text in docs]
    cut = [(id_, own, own.total()) for id_, own in cut if own]
    n_docs, length = len(cut), sum(n for *_, n in cut)
    df = Counter(t for _, own, _ in cut for t in own)
    wanted: dict = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own_terms in wanted.items():
        found = []
        for id_, own, n in cut:
            m = 100 - 50 + 50 * n * n_docs // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * own[t] // (1000 * own[t] + 20 * m)) for t in own_terms if t in own)
            if score > 0:
                found.append((-score, id_ is None, id_ or 0, id_))
        found.sort()
        out += [(item, rank, id_, -s) for rank, (s, _, _, id_) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def pairs(spark, folder, name, key):
    return [(r[key], r["text"]) for r in spark.read.parquet(f"{folder}/{name}.parquet").collect()]


@pytest.mark.parametrize("slab_terms", [1 << 20, 4])
@pytest.mark.parametrize("k", [1, 3, 50])
def test_equals_brute_force_on_hard_rows(spark, hard, k, slab_terms):
    docs, items = (spark.read.parquet(f"{hard}/{n}.parquet") for n in ("documents", "benchmark"))
    found = sorted((tuple(r) for r in ranked_search.ranked_search(docs, items, k, slab_terms=slab_terms).collect()), key=repr)
    assert found == brute_force(pairs(spark, hard, "documents", "doc_id"), pairs(spark, hard, "benchmark", "item_id"), k)


def test_ties_go_to_the_smaller_id_in_groups_larger_than_k(spark):
    docs = spark.createDataFrame([((i * 37) % 500, "same words here") for i in range(500)] + [(900, "other")],
                                 "doc_id long, text string").repartition(7)
    items = spark.createDataFrame([(1, "words"), (2, "other words")], "item_id long, text string")
    found = ranked_search.ranked_search(docs, items, 20).collect()
    assert sorted(r["doc_id"] for r in found if r["item_id"] == 1) == list(range(20))
    assert [r["doc_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["item_id"] == 2] == [900, *range(19)]


def test_no_rows_without_documents_or_items(spark, hard, empty):
    tables = {f: [spark.read.parquet(f"{f}/{n}.parquet") for n in ("documents", "benchmark")] for f in (hard, empty)}
    for docs, items in ((tables[empty][0], tables[hard][1]), (tables[hard][0], tables[empty][1])):
        found = ranked_search.ranked_search(docs, items)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.isEmpty()


def test_partial_sums_stay_exact():
    weights = np.array([[26_000.0] * 9])
    block = ranked_search.block_terms(weights, 1 << 36)
    assert block == 5 and block * 26_000 * (1 << 36) < ranked_search.EXACT
    dense = np.full((9, 2), float((1 << 37) + 1))
    dense[:, 1] = 1
    tile = ranked_search.Tile(np.array([5]), np.arange(9), weights)
    total = ranked_search.scores_of(tile, dense, ranked_search.block_terms(weights, 1 << 38))
    assert total.tolist() == [[9 * 26_000 * ((1 << 37) + 1), 9 * 26_000]]


def test_small_tiles_and_blocks_agree(spark, hard, monkeypatch):
    docs, items = (spark.read.parquet(f"{hard}/{n}.parquet") for n in ("documents", "benchmark"))
    whole = sorted(map(tuple, ranked_search.ranked_search(docs, items, 4).collect()), key=repr)
    pairs_ = ranked_search.tiles_of(np.array([3, 1, 1, 3]), np.array([0, 2, 0, 1]), np.array([5.0, 6.0, 7.0]), 1)
    tiles = list(pairs_)
    assert [t.items.tolist() for t in tiles] == [[1], [3]]
    assert [t.weights.tolist() for t in tiles] == [[[5.0, 7.0]], [[5.0, 6.0]]]
    assert [t.terms.tolist() for t in tiles] == [[0, 2], [0, 1]]
    assert whole


def test_sql_on_hard_rows(spark, hard):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{hard}/{name}.parquet'")
    want = sorted(con.execute(ORACLE_SQL["op11_ranked_search"]).fetchall(), key=repr)
    got = QUERIES["op11_ranked_search"](spark, hard).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=repr) == want
