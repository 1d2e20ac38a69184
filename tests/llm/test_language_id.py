from __future__ import annotations

import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from adrlens.llm import language_id as li
from adrlens.llm.queries import QUERIES

from .conftest import TEXTS

SMALL = "/root/testdata/sf0.001"
QUICK = li.Training(steps=60, hidden=8, words=128)


@pytest.fixture(scope="module")
def model():
    rows = pq.read_table(f"{SMALL}/documents.parquet", columns=["text", "lang"]).to_pylist()
    return li.Model.train([r["text"] for r in rows], [r["lang"] for r in rows], QUICK)


def test_gradients_by_differences():
    net = li.Network.start(3, li.Training(hidden=4))
    for w in net.weights():
        w[...] = w.astype(np.float32)
    data, mask = li.spelled([b"abc", b"de", b"xyzw"])
    target = np.array([0, 1, 2])

    def loss():
        _, p = net.positions(data, mask)
        return -(np.log(p[:, np.arange(3), target]) * mask).sum() / mask.sum()

    for w, g in zip(net.weights(), net.gradients(data, mask, target)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = w[at]
        w[at] = kept + 1e-2
        up = loss()
        w[at] = kept - 1e-2
        down = loss()
        w[at] = kept
        assert abs((up - down) / 2e-2 - g[at]) < 2e-3 * max(1, abs(g[at]))


def test_held_out_accuracy(spark):
    rows = QUERIES["op6_language_id"](spark, SMALL).collect()
    truth = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 20 and np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows) and len(rows) == len(truth)


def test_words_are_read_once_and_pooled(model):
    text = "Thé wörld " * 3 + "x" * 100 + " 12 !"
    (language, score), = li.Reader(model).predict([text])
    total = np.zeros(len(model.languages) + 1)
    for word in text.split():
        for part in li.parts_of(word):
            _, p = model.network.positions(*li.spelled([part]))
            total += [*p[:, 0].sum(0), len(p)]
    best = int(total[:-1].argmax())
    assert language == model.languages[best] and abs(score - total[best] / total[-1]) < 1e-5


def test_small_cache_gives_the_same(model, monkeypatch):
    texts = [f"word{i} other{i % 7} mañana {'é' * (i % 40)}" for i in range(200)]
    want = list(li.Reader(model).predict(texts))
    monkeypatch.setattr(li, "CAPACITY", 16)
    reader = li.Reader(model)
    got = [next(iter(reader.predict([t]))) for t in texts]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=1e-5)


def test_hard_rows(spark, hard):
    rows = QUERIES["op6_language_id"](spark, hard).collect()
    assert len(rows) == len(TEXTS)
    unknown = {r["doc_id"] for r in rows if r["lang_pred"] == "und"}
    assert unknown == {4, 5, 6, 7}
    assert all(r["score"] == 0 for r in rows if r["lang_pred"] == "und")


def test_no_labels_no_language(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "en")], "doc_id long, text string, lang string")
    rows = li.predict(docs, li.learn(docs)).collect()
    assert {(r["lang_pred"], r["score"]) for r in rows} == {("und", 0.0)}


def test_words_are_cut_between_characters():
    for word in ("x" * 100, "é" * 50, "日本" * 20, "a" + "🎉" * 17, "", "short"):
        parts = li.parts_of(word)
        assert b"".join(parts) == word.encode() and max(map(len, parts)) <= li.WORD_BYTES
        assert "".join(p.decode() for p in parts) == word


def test_a_rare_language_is_learned_from_anywhere_in_long_texts(spark):
    """One row in 2,000 has the language, which its text shows only behind 4,000 common characters."""
    noise, rare = "0123 4567 " * 420, "ζωή φως νερό γη ουρανός θάλασσα "
    rows = [(i, f"the cat sat on mat {i % 7} and the dog ran " * 3, "en") for i in range(6000)]
    rows += [(10_000 + i, noise + rare * 120, "el") for i in (0, 1, 4)]
    rows += [(20_000, rare * 3, None), (20_001, "the dog sat", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = docs.where("lang = 'el'").where(~li.held_out(F.col("doc_id"))).count()
    assert kept == 3
    model = li.learn(docs, li.Training(documents=200, steps=120))
    assert model.languages == ["el", "en"]
    found = {r["doc_id"]: r["lang_pred"] for r in li.predict(docs.where("doc_id >= 10000"), model).collect()}
    assert found == {**{10_000 + i: "el" for i in (0, 1, 4)}, 20_000: "el", 20_001: "en"}


def test_pieces_come_from_all_parts_of_a_text(spark):
    text = "".join(chr(0x4E00 + i) for i in range(10_000))
    docs = spark.createDataFrame([(text,), ("short",)], "text string")
    long, short = [r[0] for r in docs.select(li._pieces(F.col("text"), 8, 500)).collect()]
    assert short == ["short"] and len(long) == 8
    assert all(len(p) == 500 and i * 1250 <= text.index(p) <= i * 1250 + 750 for i, p in enumerate(long))
    assert li._whole_words(["ab cd ef", "gh ij kl mn"]) == "cd ij kl" and li._whole_words(["ab cd"]) == "ab cd"


def test_query_equals_reading_each_whole_text_alone(spark, hard):
    """The whole query by brute force: every position of every text, without memory of words."""
    docs = spark.read.parquet(f"{hard}/documents.parquet")
    model = li.learn(docs)
    found = sorted((r["doc_id"] or -1, r["lang_pred"], round(r["score"], 4)) for r in QUERIES["op6_language_id"](spark, hard).collect())
    want = []
    for r in docs.collect():
        words = (r["text"] or "").split()
        if not li.LETTER.search(r["text"] or ""):
            want.append((r["doc_id"] or -1, li.UNKNOWN, 0.0))
            continue
        total, positions = 0, 0
        for part in (p for w in words for p in li.parts_of(w)):
            _, p = model.network.positions(*li.spelled([part]))
            total, positions = total + p[:, 0].sum(0, dtype=np.float64), positions + len(p)
        want.append((r["doc_id"] or -1, model.languages[int(total.argmax())], round(min(1.0, float(total.max() / positions)), 4)))
    assert [f[:2] for f in found] == [w[:2] for w in sorted(want)]
    assert np.allclose([f[2] for f in found], [w[2] for w in sorted(want)], atol=2e-4)
