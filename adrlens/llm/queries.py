"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from adrlens.llm import (bpe, host_reputation, language_id, merkle, metric_join, packing, ranked_search,
                         secret_scan, suffix_dedup, token_count, topk_search, wavelet, weighted_minhash)
from adrlens.session import new_shared_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BYTE_BPE, WORD_BPE = "byte_bpe_50k.json", "word_bpe_49k.json"
END_ID = 2
SEQUENCE_TOKENS = 1024

REPUTATION = host_reputation.Reputation(rules=(
    host_reputation.Rule("block", "net", "/"),
    host_reputation.Rule("allow", "example.net", "/en/"),
    host_reputation.Rule("block", "example.com", "/de/"),
    host_reputation.Rule("allow", "org", "/fr/"),
))
SECRETS = secret_scan.BASE_RULES + secret_scan.MORE_RULES


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_topk_search(spark, sf_dir):
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query
def op2_wavelet_tokens(spark, sf_dir):
    """Documents read back from wavelet-matrix token files."""
    path = new_shared_path(spark, "token-files")
    wavelet.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer(WORD_BPE), END_ID)
    documents = wavelet.read_documents(spark, path, digests=True)
    return (wavelet.with_starts(documents, wavelet.read_shards(spark, path))
            .select("doc_id", "start", "n_tokens", "ids_crc32"))


@query
def op3_host_reputation(spark, sf_dir):
    """Verdict of every page; an outcome is bad where the page's label is toxic or of low quality."""
    bad = F.greatest(F.col("toxic"), 1 - F.col("quality"))
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    judged = host_reputation.judge_pages(table(spark, sf_dir, "pages"), outcomes, REPUTATION)
    return judged.withColumns({c: F.round(c, 6) for c in ("bad_mean", "bad_bound")})


@query
def op4_metric_range_join(spark, sf_dir):
    """Links and component of every vector at cosine 0.95."""
    return metric_join.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.95)


@query
def op5_trie_bpe(spark, sf_dir):
    """Ids and decoded text of every document, as digests."""
    return bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), digests=True)


@query
def op6_language_id(spark, sf_dir):
    """Language of every document, from a model that has not seen the held-out part."""
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.learn(docs))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op7_token_counts(spark, sf_dir):
    """Token counts of every document."""
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), SEQUENCE_TOKENS)


@query
def op8_weighted_minhash(spark, sf_dir):
    """Class of near-duplicates of every document."""
    return weighted_minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op9_sequence_packing(spark, sf_dir):
    """Place of every piece of every document in sequences of 1024 tokens."""
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE),
                                  SEQUENCE_TOKENS, END_ID)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS)


@query
def op10_secret_scan(spark, sf_dir):
    """Secrets of every document: counts of the base kinds and all spans."""
    found = secret_scan.find_secrets(table(spark, sf_dir, "documents"), SECRETS)
    base = [r.kind for r in secret_scan.BASE_RULES]

    def of_kinds(*kinds):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *(F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(joined(of_kinds(*base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


@query
def op11_ranked_search(spark, sf_dir):
    """The 50 best documents of every benchmark item."""
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


@query
def op12_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document, and whether a tampered text is found out."""
    docs = table(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    altered = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaves = docs.select("doc_id", "source", merkle.leaf([*columns, F.col("text")]).alias("leaf"),
                         merkle.leaf([*columns, altered]).alias("altered"))
    proved = merkle.manifest(leaves, "source", "doc_id", "leaf")
    return (proved.withColumn("folded_root", merkle.folded(F.col("altered"), F.col("proof")))
            .select("doc_id", "leaf", "subroot", "root", merkle.digest(merkle.siblings(F.col("proof"))).alias("proof_sha256"),
                    "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")))


@query
def op13_suffix_dedup(spark, sf_dir):
    """What stays of every document once each 100-byte string is left out where it repeats."""
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))
