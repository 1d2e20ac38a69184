"""The pipeline and all queries on hard and empty tables."""

from __future__ import annotations

import os

import pyarrow.parquet as pq
import pytest

import __spark_entry__
import corpus_pipeline
from adrlens.llm import common, packing, secret_scan
from adrlens.llm.queries import QUERIES, SECRETS
from adrlens.session import shared_folder

from .test_weighted_minhash import classes

SMALL = "/root/testdata/sf0.001"


def test_stages_on_small_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = pq.read_table(f"{SMALL}/documents.parquet").to_pylist()
    columns, left = docs.columns, {r["doc_id"]: r["text"] for r in rows}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), name)
        if name == "packing":
            break
        assert docs.columns == columns
        found = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name == "language":
            assert all(not any(map(str.isalpha, left[i])) for i in left.keys() - found.keys())
        elif name == "near_duplicates":
            assert sorted(found) == [i for i, _, kept in sorted(classes(list(left.items()))) if kept]
        elif name == "secrets":
            scanner = secret_scan.Scanner(SECRETS)
            for i, spans in zip(left, scanner.scan(list(left.values()))):
                assert found[i] == secret_scan._without(left[i], spans, "[REDACTED]")
        left = found
    pieces = docs.collect()
    assert {r["doc_id"] for r in pieces} == set(left)
    assert len({r["sequence_id"] for r in pieces}) <= 1.1 * sum(r["length"] for r in pieces) / 1024 + 1


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_keep_extra_columns_and_hard_rows(spark, hard, empty, name, stage):
    for folder in (hard, empty):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        out = stage(spark, docs, folder)
        rows = out.collect()
        if name != "packing":
            assert out.columns == docs.columns
            assert len(rows) <= docs.count() and (folder == empty or len(rows) > 8)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_on_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_registered_once_each():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert packing.piece_lengths(1, 1024) == [1]


def test_only_the_result_is_left_in_the_shared_folder(spark):
    before = set(os.listdir(shared_folder(spark)))
    rows = corpus_pipeline.run(spark, SMALL)
    new = sorted(set(os.listdir(shared_folder(spark))) - before)
    assert [n.rsplit("-", 1)[0] for n in new] == ["packing"] and rows.count() > 100


def test_a_worker_keeps_the_memory_of_one_operator():
    common._KEPT.clear()
    assert common.kept_by_worker("one", "a", 1, lambda: "x") == "x" and common.kept_by_worker("one", "b", 1, list) == []
    assert common.kept_by_worker("one", "a", 1, lambda: "y") == "x" and common.kept_by_worker("one", "a", 2, lambda: "z") == "z"
    assert common.kept_by_worker("two", "a", 1, dict) == {} and list(common._KEPT) == ["two"]
    common._KEPT.clear()


def test_a_lean_call_gives_its_memory_back():
    def resident():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")

    def work(count):  # blocks too small to be mapped one by one
        held = [bytes([1]) * 60_000 for _ in range(count)]
        pinned.append(bytes(60_000))  # behind them, so that the heap's end can't fall
        return len(held)

    pinned: list[bytes] = []
    before = resident()
    assert common.lean(work, 2_000) == 2_000
    assert resident() - before < 40_000_000
    with pytest.raises(ZeroDivisionError):
        common.lean(lambda: 1 // 0)
