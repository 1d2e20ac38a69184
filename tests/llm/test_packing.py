from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st

from adrlens.llm import chunks, packing
from adrlens.llm.queries import BYTE_BPE, QUERIES, tokenizer

from .conftest import TEXTS


def assert_gapless(places, capacity):
    bins = defaultdict(list)
    for sequence, offset, length in places:
        bins[sequence].append((offset, length))
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@settings(max_examples=200, deadline=None)
@given(lengths=st.lists(st.integers(1, 60), min_size=1, max_size=300))
def test_plan_fills_bins_without_gaps(lengths):
    counts = Counter(lengths)
    plan = packing.Plan(counts, 60)
    places = [(s, o, n) for n, c in counts.items() for s, o in zip(*map(np.ndarray.tolist, plan.find(n, np.arange(c))))]
    bins = assert_gapless(places, 60)
    assert bins == plan.bins
    assert bins <= 1.25 * -(-sum(lengths) // 60) + sum(2 * n > 60 for n in lengths) / 2 + 2


def test_large_items_pair_at_most_twice():
    plan = packing.Plan({50: 4, 40: 3, 30: 2, 20: 1, 5: 10}, 90)
    assert plan.bins == 5  # 450 tokens: 50+40 three times, 50+30+5+5, the rest
    assert packing.Plan({31: 3}, 90).bins == 2


@pytest.mark.parametrize("tokens, pieces", [(1, [1]), (10, [10]), (11, [1, 10]), (20, [10, 10]), (25, [5, 10, 10])])
def test_first_piece_takes_the_rest(tokens, pieces):
    assert packing.piece_lengths(tokens, 10) == pieces


def test_op9_on_hard_rows(spark, hard):
    rows = QUERIES["op9_sequence_packing"](spark, hard).collect()
    encoder, want = chunks.library(tokenizer(BYTE_BPE)), []
    for i, text in TEXTS:
        ids, start = [*encoder.encode(text or "", add_special_tokens=False).ids, 2], 0
        for piece, length in enumerate(packing.piece_lengths(len(ids), 1024)):
            want.append((i, piece, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())))
            start += length
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == sorted(want, key=repr)
    assert_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 1024)


def test_columns_pass_through(spark):
    pieces = spark.createDataFrame([(i % 7 + 1, f"p{i}", -1, -2) for i in range(500)],
                                   "length long, bucket string, rank int, offset int")
    rows = packing.pack(pieces, 10).collect()
    assert sorted(r["bucket"] for r in rows) == sorted(f"p{i}" for i in range(500))
    assert {r["rank"] for r in rows} == {-1}
    assert_gapless([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 10)


def test_equal_rows_are_dealt_out(spark, monkeypatch):
    """20,000 equal pieces: no bucket holds more than about its share."""
    monkeypatch.setattr(packing, "BUCKET_PIECES", 1000)
    pieces = spark.range(20_000).repartition(4).select(F.lit(1).cast("long").alias("doc_id"), F.lit(300).cast("long").alias("length"))
    sizes = []
    kept = packing.written

    def written(df, name, **options):
        out = kept(df, name, **options)
        if name == "pieces":
            sizes.extend(r["count"] for r in out.groupBy(F.pmod("bucket", F.lit(20))).count().collect())
        return out

    monkeypatch.setattr(packing, "written", written)
    placed = packing.pack(pieces, 1024)
    assert len(sizes) == 20 and max(sizes) < 1200
    assert placed.select("sequence_id").distinct().count() == -(-20_000 // 3)
    assert placed.select("sequence_id", "offset").distinct().count() == 20_000
