"""What the language stage of the pipeline removes and what it keeps."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adrlens.llm import language_id as li

FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. ",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. ",
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")


def left(spark, docs):
    return {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").select("doc_id").collect()}


def test_long_foreign_texts_go_and_clean_pieces_stay(spark, docs):
    pieces = [p for r in docs.where("doc_id < 60").collect() for p in li.runs_of_words(r["text"] or "")]
    clean = {10**6 + i: p for i, p in enumerate(pieces) if li.LETTER.search(p)}
    foreign = {2 * 10**6 + i: t * 40 for i, t in enumerate(FOREIGN)}
    planted = spark.createDataFrame([(i, t, None) for i, t in {**clean, **foreign}.items()], docs.schema)
    found = left(spark, docs.unionByName(planted))
    assert not found & foreign.keys()
    assert clean.keys() <= found
    assert {r["doc_id"] for r in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()} <= found


def test_without_labels_only_texts_without_letters_go(spark, docs):
    hard = spark.createDataFrame([(-1, None, None), (-2, "", None), (-3, "12 ... !", None)], docs.schema)
    some = docs.limit(50).withColumn("lang", F.lit(None).cast("string")).unionByName(hard)
    found = left(spark, some)
    assert found == {r["doc_id"] for r in some.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}


def test_bound_rises_with_size_and_needs_many_pieces():
    model = li.Model.train(["the cat sat on it"] * 3 + ["der hund lag da"] * 3, ["en"] * 3 + ["de"] * 3,
                           li.Training(steps=20, hidden=4, words=32))
    def least_of(texts):
        return li.bounds(li.scores_by_size(li.Reader(model), texts), len(model.languages))

    assert set(least_of(["the cat sat"] * 5)) == {0.0}
    least = least_of([f"the cat sat on it {'and so on ' * (i % 20)}" for i in range(200)])
    assert least == sorted(least) and max(least) > 0


def test_the_bound_comes_from_all_held_out_documents(spark):
    """The worst of 2,100 held-out documents is the last in the order in which a sample was once drawn."""
    model = li.Model.train(["the cat sat on it"] * 3 + ["der hund lag da"] * 3, ["en"] * 3 + ["de"] * 3,
                           li.Training(steps=150, hidden=8, words=64))
    ids = spark.range(10_000).where(li.held_out(F.col("id"))).orderBy(F.xxhash64("id")).limit(2_100)
    ids = [r["id"] for r in ids.orderBy(F.xxhash64("id")).collect()]
    texts = ["the cat sat on it" + " cat" * (i % 3) for i in ids[:-1]] + ["der the hund cat lag sat"]
    rows = [(i, t, "en") for i, t in zip(ids, texts)]
    docs = spark.createDataFrame(rows + rows[:500], "doc_id long, text string, lang string")  # some twice
    found = li.least_scores(docs.repartition(3), model)
    assert found == pytest.approx(li.bounds(li.scores_by_size(li.Reader(model), texts), 2), abs=1e-5)
    assert found != pytest.approx(li.bounds(li.scores_by_size(li.Reader(model), texts[:-1]), 2), abs=1e-5)
