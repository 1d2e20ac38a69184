"""Corpus pipeline: stages over the table of documents, each written and read by the next.

1. ``language``: a text that is null or without letters goes, and one in none of the labelled
   languages, as far as its length allows to tell.  Without labels only the first go.
2. ``near_duplicates``: one document of each group of near-duplicates stays, the one of
   smallest id.
3. ``secrets``: every secret found is replaced by a mark; documents stay.
4. ``packing``: the documents' tokens are cut into pieces and packed into sequences.

All stages but the last return the columns they are given, extra ones included.  Null and empty
texts have no letters and go in the first stage; taken alone, the later ones keep them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adrlens.llm import language_id, packing, secret_scan, weighted_minhash
from adrlens.llm.common import discard, written
from adrlens.llm.queries import BYTE_BPE, END_ID, SECRETS, SEQUENCE_TOKENS, tokenizer
from adrlens.session import intermediates

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.learn(docs)
    return language_id.accepted(docs, model, language_id.least_scores(docs, model))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return weighted_minhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs, SECRETS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(docs, tokenizer(BYTE_BPE), SEQUENCE_TOKENS, END_ID)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", pack)]

ORACLE_SQL: str | None = None  # a trained network and sampled sketches are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages wrote on the way is removed, their outputs too."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in STAGES:
        with intermediates(spark):
            docs = written(stage(spark, docs, sf_dir), name, result=True)
        discard(*before)
        before = [docs]
    return docs
