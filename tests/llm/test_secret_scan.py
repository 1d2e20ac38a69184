from __future__ import annotations

import hashlib
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from adrlens.llm import secret_scan
from adrlens.llm.chunks import batch_slices
from adrlens.llm.queries import QUERIES, SECRETS

from .conftest import TEXTS

PIECES = st.sampled_from(["password", "Passwd", "SECRET", "token", "api_key", "APIKEY", "ap i", "AKIA", "ABCDEFGH12345678",
                          "0123456789abcdef", "ff", "=", ": ", ' "', "é", "\n", " ", "x", "hunter22", "ghp_", "a" * 36,
                          "eyJhbGciOi", ".", "-----BEGIN RSA PRIVATE KEY-----", "xoxb-", "K", "ſecret"])


def brute(text):
    found = []
    for number, rule in enumerate(SECRETS):
        for m in rule.compiled().finditer(text):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), number, m.end()))
    return sorted(found)


@settings(max_examples=200, deadline=None)
@given(texts=st.lists(st.lists(PIECES, max_size=12).map("".join), max_size=8))
def test_scan_equals_searching_all(texts):
    assert secret_scan.Scanner(SECRETS).scan(texts) == [brute(t) for t in texts]


@pytest.mark.parametrize("pattern, query", [
    ("abcd", ("and", (b"abc", b"bcd"))), ("AbC", b"abc"), ("ab?c", True), ("(abc|xyz)1", ("or", (("and", (b"abc", b"bc1")),
     ("and", (b"xyz", b"yz1"))))), ("abc.*def", ("and", (b"abc", b"def"))), ("(abc)+x", b"abc"), ("[a-z]+", True),
    ("(abc)?", True), ("(?:abc|x)def", ("or", (("and", (b"abc", b"bcd", b"cde", b"def")), ("and", (b"xde", b"def"))))),
    ("(abc.|.def)", ("or", (b"abc", b"def"))),
])
def test_queries_of_patterns(pattern, query):
    assert secret_scan.trigram_query(secret_scan.Rule("x", pattern)) == query


def test_hex_rule_scans_everything():
    queries = {r.kind: secret_scan.trigram_query(r) for r in SECRETS}
    assert queries["hex"] is True and queries["access"] == ("and", (b"aki", b"kia"))


def test_op10_on_hard_rows(spark, hard):
    def row(i, text):
        spans = [(SECRETS[k].kind, s, e) for s, k, e in brute(text or "")]
        base = [x for x in spans if x[0] in ("assign", "access", "hex")]
        joined = lambda own: ",".join(f"{k}:{s}:{e}" for k, s, e in own)
        counts = [sum(x[0] == kind for x in base) for kind in ("assign", "access", "hex")]
        return (i, *counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))

    rows = [tuple(r) for r in QUERIES["op10_secret_scan"](spark, hard).collect()]
    assert sorted(rows, key=repr) == sorted((row(*t) for t in TEXTS), key=repr)
    assert sum(r[1] for r in rows) == 1 and sum(r[2] for r in rows) == 1 and sum(r[3] for r in rows) >= 1


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "é password=abcdef1 x", 20, "k"), (2, "clean", 5, None), (3, None, None, None)],
                                 "doc_id long, text string, n_chars long, spans string")
    rows = {r["doc_id"]: (r["text"], r["n_chars"], r["spans"]) for r in secret_scan.redact(docs, SECRETS).collect()}
    assert rows == {1: ("é [REDACTED] x", 14, "k"), 2: ("clean", 5, None), 3: (None, None, None)}


def test_overlapping_spans_become_one_mark():
    assert secret_scan._without("abcdefgh", [(1, 0, 4), (2, 1, 6), (7, 0, 8)], "*") == "a*g*"


def test_redaction_without_a_count_of_characters(spark):
    docs = spark.createDataFrame([(1, 'password = "hunter2hunter"', "x"), (2, None, "y")], "doc_id long, text string, bucket string")
    found = secret_scan.redact(docs, secret_scan.BASE_RULES)
    assert found.columns == docs.columns
    texts = {r["doc_id"]: r["text"] for r in found.collect()}
    assert "[REDACTED]" in texts[1] and "hunter" not in texts[1] and texts[2] is None


def test_scanning_takes_little_more_memory_than_the_texts():
    scanner = secret_scan.Scanner(SECRETS)
    text = "a token of some words, then more " * 60_000 + "password=abcdef1"
    tracemalloc.start()
    found = scanner.scan([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(s, e) for s, _, e in found[0]] == [(len(text) - 16, len(text))]
    assert peak < 8 * len(text)


def test_trigrams_at_the_border_of_two_lookups(monkeypatch):
    texts = ["x" * i + "password=abcdef1 AKIA" + "Q7" * 9 + " é" for i in range(12)] + ["", "to", "ken"]
    for size in (1, 2, 5, 7):
        monkeypatch.setattr(secret_scan, "INDEX_BYTES", size)
        assert secret_scan.Scanner(SECRETS).scan(texts) == [brute(t) for t in texts]


def test_batches_are_read_in_slices():
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["abcd", None, "", "éé", "x" * 30, "y"])], ["id", "text"])
    parts = [p.to_pydict() for p in batch_slices(batch, 1, size=8)]
    assert [p["id"] for p in parts] == [[0, 1, 2, 3], [4], [5]] and parts[0]["text"] == ["abcd", None, "", "éé"]
    assert list(batch_slices(batch.slice(0, 0), 1)) == []
