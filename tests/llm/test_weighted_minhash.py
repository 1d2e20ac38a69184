from __future__ import annotations

import math
import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from adrlens.llm import shingles, weighted_minhash as wm
from adrlens.llm.queries import QUERIES

from .conftest import TEXTS


def words(text):
    out, own = [], b""
    plain = "".join(" " if c > "\x7f" and unicodedata.category(c)[0] in "ZPSC" else c for c in text or "")
    for b in plain.lower().encode():
        if b >= 128 or chr(b).isalnum():
            own += bytes([b])
        else:
            out, own = out + [own] * bool(own), b""
    return out + [own] * bool(own)


def sets(texts, size=5):
    split = [words(t) for t in texts]
    return [Counter(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter() for w in split]


def classes(rows, least=wm.Sampling().bar):
    """Smallest id that weighted Jaccard links lead to; rows of one id are one document."""
    rows = [(i, t) for i, t in rows]
    known = [(i, t) for i, t in rows if i is not None and t is not None]
    own = sets([t for _, t in known])
    df = Counter(s for c in own for s in c)
    n = max(2, len(known))
    weight = [{s: c * (1 + wm.IDF_RANGE * math.log(n / df[s]) / math.log(n)) for s, c in o.items()} for o in own]
    label = {i: i for i, _ in rows if i is not None}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(known)):
        for b in range(a):
            shared = sum(min(weight[a][s], weight[b][s]) for s in weight[a].keys() & weight[b].keys())
            if shared and shared / (sum(weight[a].values()) + sum(weight[b].values()) - shared) >= least:
                low, high = sorted((root(known[a][0]), root(known[b][0])))
                label[high] = low
    return sorted(((i, None if i is None else root(i), i is None or root(i) == i) for i, _ in rows), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_op8_on_hard_rows(spark, hard):
    assert found(QUERIES["op8_weighted_minhash"](spark, hard)) == classes(TEXTS)


def test_copies_near_copies_and_chains(spark, frame):
    pick = random.Random(4)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts, passage = [], [pick.choice(vocabulary) for _ in range(40)]
    for group in range(25):
        base = [pick.choice(vocabulary) for _ in range(pick.randint(60, 300))] + passage
        texts.append(base)
        for _ in range(group % 5):
            base = list(base)  # a chain: each differs a little from the one before
            base[pick.randrange(len(base))] = pick.choice(vocabulary)
            texts.append(base)
        texts.append(list(base))
    rows = [(i, " ".join(t).title() if i % 2 else ", ".join(t)) for i, t in enumerate(texts)]
    pick.shuffle(rows)
    want = classes(rows)
    assert sum(not r[2] for r in want) > 50
    assert found(wm.near_duplicates(frame(rows))) == want


@pytest.mark.parametrize("limit", [3_000, 1 << 21])
def test_group_whose_members_are_not_like_the_first(frame, monkeypatch, limit):
    """A ring of documents: each is near its neighbours only."""
    monkeypatch.setattr(wm, "BUCKET_SHINGLES", limit)
    vocabulary = [f"v{i}" for i in range(4000)]
    rows = [(i, " ".join(vocabulary[j % 600] for j in range(i * 5, i * 5 + 100))) for i in range(120)]
    rows += [(500 + i, " ".join(vocabulary[1000 + 100 * i:1080 + 100 * i] + vocabulary[900:920])) for i in range(20)]
    assert found(wm.near_duplicates(frame(rows))) == classes(rows)


def test_links_of_a_bucket():
    import pandas as pd

    sets = [{1, 2, 3, 4, 5, 6, 7, 8, 9}, {1, 2, 3, 4, 5, 6, 7, 8}, {1, 2, 3, 4, 5, 6, 7}, {1, 20}, {1, 20, 21}]
    frame = pd.DataFrame({
        "node": range(5), "component": [0, 1, 2, 0, 4],
        "shingles": [np.array(sorted(s), "<u8").tobytes() for s in sets],
        "weights": [np.ones(len(s), "<f4").tobytes() for s in sets]})
    got = wm.bucket_links(frame, 0.8)
    assert sorted(map(tuple, map(sorted, got.to_numpy().tolist()))) in ([(0, 1), (1, 2)], [(0, 1), (0, 2)])
    assert len(wm.bucket_links(frame, 0.6)) == 3


def test_one_of_each_stays(spark):
    rows = [(3, "a b c d e f g", "x"), (1, "A b, c d e f g!", "y"), (1, "A b, c d e f g!", "y"), (2, "other words", "z"),
            (2, "other words", "z"), (None, "a b c d e f g", "n"), (None, "a b c d e f g", "n"), (5, None, None), (6, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    assert sorted(map(repr, found(wm.one_of_each(docs)))) == sorted(map(repr, [
        (1, "A b, c d e f g!", "y"), (2, "other words", "z"), (None, "a b c d e f g", "n"), (None, "a b c d e f g", "n"),
        (5, None, None), (6, "", None)]))


@settings(max_examples=50, deadline=None)
@given(texts=st.lists(st.text("ab é,.\nÄß日0", max_size=60), max_size=6))
def test_shingles_equal_word_tuples(texts):
    hashed = [s for s, _ in shingles.Shingler(3).of(texts)]
    plain = [[tuple(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if (w := words(t)) else [] for t in texts]
    assert [len(h) for h in hashed] == [len(p) for p in plain]
    names = {}
    for own, wanted in zip(hashed, plain):
        for h, p in zip(own.tolist(), wanted):
            assert names.setdefault(p, h) == h
    assert len(set(names.values())) == len(names)


def test_long_words_and_chunks(monkeypatch):
    texts = ["x" * 5000 + " y " + "ab " * 900, "", "ab " * 900 + "z" * 70]
    want = [(s.tolist(), w) for s, w in shingles.Shingler(5).of(texts)]
    monkeypatch.setattr(shingles, "CHUNK", 64)
    assert [(s.tolist(), w) for s, w in shingles.Shingler(5).of(texts)] == want


def test_samples_agree_as_often_as_sets_are_similar():
    rng = np.random.default_rng(0)
    shared, a, b = (np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (600, 150, 150))
    one, two = np.union1d(shared, a), np.union1d(shared, b)
    weight = lambda s: (1 + (s % np.uint64(3)).astype(np.float32) / 2)
    drawn = [wm.sample(s, weight(s), 600) for s in (one, two)]
    assert abs(np.mean(drawn[0] == drawn[1]) - wm.similarity(one, weight(one), two, weight(two))) < 0.06
    heavier = weight(one) * np.float32(1.5)
    assert abs(np.mean(drawn[0] == wm.sample(one, heavier, 600)) - 1 / 1.5) < 0.06


@given(values=st.lists(st.integers(0, (1 << 64) - 1), max_size=40))
def test_packing_of_hashes(values):
    own = np.array(sorted(values), np.uint64)
    assert shingles.unpack_sorted(shingles.pack_sorted(own)).tolist() == own.tolist()


@pytest.mark.parametrize("n", [1, 2, 50])
def test_weights_lie_between_one_and_two(n):
    import pandas as pd

    shared = np.array([5, 9], np.uint64)
    answers = pd.DataFrame({"shingles": [shingles.pack_sorted(shared)], "counts": [np.array([n, n], "<u4").tobytes()]})
    found, weight = wm.Weights(answers, n).of(np.array([9, 7, 9], np.uint64))
    most = np.float32(1 + wm.IDF_RANGE)
    assert found.tolist() == [7, 9] and 1 <= weight[0] <= most and 2 <= weight[1] <= 2 * most


@pytest.mark.parametrize("group", [2, 100, 700])
def test_copies_of_plain_similarity_link_in_groups_of_every_size(frame, group):
    """Each copy has private words in place of some, in the midst of other documents (2,100 in all)."""
    pick, rows = random.Random(group), []
    base = [f"w{i}" for i in range(1000)]
    changes = {0.8: 22, 0.85: 16, 0.9: 10}  # of words five apart at least: five shingles each
    plain = {}
    for i in range(group):
        wanted = list(changes)[(i - 1) % 3]
        own = list(base)
        for at in pick.sample(range(199), changes[wanted]) if i else []:
            own[5 * at + 2] = f"p{i}x{at}"
        rows.append((i, " ".join(own)))
        a, b = (set(zip(*(w[j:] for j in range(5)))) for w in (base, own))
        plain[i] = len(a & b) / len(a | b)
    rows += [(10_000 + i, " ".join(f"o{i}x{j}" for j in range(20))) for i in range(2100 - group)]
    assert all(s >= 0.799 for s in plain.values()) and min(plain.values()) < 0.803
    found_ = {r[0]: r[1] for r in wm.near_duplicates(frame(rows)).collect()}
    linked = [found_[i] == 0 for i in plain if plain[i] >= 0.8]
    assert sum(linked) >= 0.99 * len(linked)
    assert all(found_[i] == i for i in found_ if i >= 10_000)


def test_signs_beyond_ascii_separate_words():
    same = ["it\u2019s a \u201ctest\u201d \u2014 of\u00a0words", "it s a test of words", "It's a 'test' - of words"]
    assert len({w for _, w in shingles.Shingler(5).of(same)}) == 1
    assert len({w for _, w in shingles.Shingler(5).of(["na\u00efve caf\u00e9", "nai ve caf e"])}) == 2
