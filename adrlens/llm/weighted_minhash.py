"""Near-duplicate documents by improved consistent weighted sampling over TF-IDF shingles.

1. Documents are dealt into blocks by hash.  Each block sends its distinct shingles, cut by hash
   into buckets, as packed arrays; a bucket counts in how many documents each shingle occurs and
   sends the counts above one back to the blocks that asked.
2. Each document is a weighted set: weight = occurrences x idf, idf = 1 + IDF_RANGE ln(N / df) / ln(N),
   from 1 (in every document) to 1 + IDF_RANGE (in one).  The range is narrow, so that a copy's
   few private changes weigh little more than what its group shares, however large the group is;
   the bar is set so low that no pair of the wanted plain similarity fails for it.  Improved consistent weighted sampling draws ``samples``
   (shingle, step) pairs; two documents agree on each with the probability of their weighted
   Jaccard similarity.  Bands of samples are keys.
3. Documents with the same words in the same order are one class from here on.  In every bucket
   of a band all classes are paired with the smallest; pairs are verified by the exact weighted
   Jaccard similarity, links form components.  Where a bucket then still holds classes of
   different components, all its weighted sets meet in an inverted index, so no pair that
   shares a key is lost unless its classes are linked already; only links leave the task.

Random numbers of a shingle come from a table of fixed seed, by some bits of its hash; a draw
is the shingle itself with its step, so shingles sharing a row are not taken for each other.

Defined results: a text without words (null, empty, signs only) links with nothing; a text of
fewer words than a shingle is one shingle; rows without an id link with nothing and have a null
class; rows that share an id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from adrlens.llm.common import join_small, kept_by_worker, lean, parts_for, ranges, written
from adrlens.llm.components import components
from adrlens.llm.shingles import Shingler, mix, pack_sorted, unpack_sorted
from adrlens.session import intermediates

BLOCK_CHARS = 1 << 23  # text of a block
BUCKET_CHARS = 1 << 23  # text whose shingles fall into a bucket
SLOTS = 1 << 15
BUCKET_SHINGLES = 1 << 21  # shingles of a bucket that meet in one task
FEW = 500_000  # ids that may be broadcast
IDF_RANGE = 0.05


@dataclass(frozen=True)
class Sampling:
    words: int = 5
    bands: int = 10
    rows: int = 3
    similarity: float = 0.8

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def bar(self) -> float:
        """The least weighted similarity that a pair of plain ``similarity`` can have."""
        return self.similarity / (self.similarity + (1 + IDF_RANGE) * (1 - self.similarity)) - 1e-6  # for rounding


def draws(samples: int) -> tuple[np.ndarray, ...]:
    """Random numbers of consistent weighted sampling per slot: 1/r, r, beta, ln c - r."""
    return kept_by_worker("minhash", "draws", samples, lambda: _new_draws(samples))


def _new_draws(samples: int) -> tuple[np.ndarray, ...]:
    random = np.random.default_rng(20100101)
    r = random.gamma(2.0, 1.0, (SLOTS, samples)).astype(np.float32) + np.float32(1e-6)
    c = random.gamma(2.0, 1.0, (SLOTS, samples)).astype(np.float32) + np.float32(1e-30)
    beta = random.random((SLOTS, samples), np.float32)
    return 1 / r, r, beta, np.log(c) - r


def shingler(words: int) -> Shingler:
    return kept_by_worker("minhash", "shingler", words, lambda: Shingler(words))


def sample(shingles: np.ndarray, weights: np.ndarray, samples: int) -> np.ndarray:
    """One draw per sample, as a hash of shingle and step; shingles ascending and distinct."""
    inverse, r, beta, rest = draws(samples)
    best = np.full(samples, np.inf, np.float32)
    drawn = np.zeros(samples, np.uint64)
    log_weight = np.log(weights).astype(np.float32)[:, None]
    for begin in range(0, len(shingles), 2048):
        part = slice(begin, begin + 2048)
        slot = (shingles[part] >> np.uint64(40)).astype(np.int64) & (SLOTS - 1)
        step = np.floor(log_weight[part] * inverse[slot] + beta[slot])
        score = rest[slot] - r[slot] * (step - beta[slot])
        first = score.argmin(0)
        low = score[first, np.arange(samples)]
        better = low < best
        best[better] = low[better]
        chosen = mix(shingles[part][first] ^ mix(step[first, np.arange(samples)].astype(np.int64).view(np.uint64)))
        drawn[better] = chosen[better]
    return drawn


def band_keys(drawn: np.ndarray, bands: int) -> np.ndarray:
    keys = np.arange(bands, dtype=np.uint64)
    for row in drawn.reshape(bands, -1).T:
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + row)
    return keys.view(np.int64)


def similarity(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two weighted sets with ascending, distinct members."""
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    same = b[at] == a
    shared = np.minimum(wa[same], wb[at[same]]).sum(dtype=np.float64)
    return shared / (wa.sum(dtype=np.float64) + wb.sum(dtype=np.float64) - shared)


def _blocks(docs: DataFrame, count: int) -> DataFrame:
    return docs.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(count)).cast("int"))


def document_counts(blocks: DataFrame, words: int, buckets: int) -> DataFrame:
    """(block, shingles, counts): per block its shingles that occur in several documents."""
    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        own = [np.unique(s) for s, _ in shingler(words).of(frame["text"].tolist())]
        found, counts = np.unique(np.concatenate(own), return_counts=True)
        limits = [(b << 64) // buckets for b in range(1, buckets)]  # by the leading bits
        cuts = [0, *np.searchsorted(found, np.array(limits, np.uint64)), len(found)]
        rows = [(b, pack_sorted(found[i:j]), counts[i:j].astype("<u4").tobytes())
                for b, (i, j) in enumerate(zip(cuts, cuts[1:])) if i < j]
        return pd.DataFrame(rows, columns=["bucket", "shingles", "counts"]).assign(block=int(frame["block"].iloc[0]))

    def count(frame: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack_sorted(s) for s in frame["shingles"]]
        every = np.concatenate(parts)
        order = np.argsort(every, kind="stable")
        every = every[order]
        first = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
        counts = np.concatenate([np.frombuffer(c, "<u4") for c in frame["counts"]])[order]
        sums = np.add.reduceat(counts.astype(np.int64), first)
        shared, sums = every[first][sums > 1], sums[sums > 1]
        rows = []
        for block, part in zip(frame["block"], parts):
            at = np.searchsorted(shared, part)
            hit = at < len(shared)
            hit[hit] = shared[at[hit]] == part[hit]
            if hit.any():
                rows.append((block, pack_sorted(part[hit]), sums[at[hit]].astype("<u4").tobytes()))
        return pd.DataFrame(rows, columns=["block", "shingles", "counts"])

    asked = blocks.groupBy("block").applyInPandas(lambda frame: lean(ask, frame), "bucket int, shingles binary, counts binary, block int")
    return asked.groupBy("bucket").applyInPandas(lambda frame: lean(count, frame), "block int, shingles binary, counts binary")


class Weights:
    """Weighted sets of the documents of one block."""

    def __init__(self, answers: pd.DataFrame, documents: int):
        shared = [unpack_sorted(s) for s in answers["shingles"]]
        counts = [np.frombuffer(c, "<u4") for c in answers["counts"]]
        shared = np.concatenate([np.empty(0, np.uint64), *shared])
        counts = np.concatenate([np.empty(0, "<u4"), *counts])
        order = np.argsort(shared)
        self.shared, self.counts = shared[order], counts[order].astype(np.float64)
        self.documents = max(documents, 2)

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, times = np.unique(shingles, return_counts=True)
        df = np.ones(len(found))
        if len(self.shared):
            at = np.minimum(np.searchsorted(self.shared, found), len(self.shared) - 1)
            hit = self.shared[at] == found
            df[hit] = self.counts[at[hit]]
        idf = 1 + IDF_RANGE * np.log(self.documents / df) / np.log(self.documents)
        return found, (times * np.maximum(idf, 1)).astype(np.float32)


def signatures(blocks: DataFrame, counts: DataFrame, documents: int, config: Sampling) -> DataFrame:
    """(id, words, size, keys): hash of all words, shingles and band keys of documents with words."""
    def sign(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        weights, rows = Weights(answers, documents), []
        if len(frame):
            for id_, (own, whole) in zip(frame["id"], shingler(config.words).of(frame["text"].tolist())):
                if len(own):
                    rows.append((id_, whole, len(own), band_keys(sample(*weights.of(own), config.samples), config.bands)))
        return pd.DataFrame(rows, columns=["id", "words", "size", "keys"])

    return (blocks.groupBy("block").cogroup(counts.groupBy("block"))
            .applyInPandas(lambda frame, answers: lean(sign, frame, answers), "id long, words long, size long, keys array<long>"))


def weighted_sets(blocks: DataFrame, counts: DataFrame, documents: int, words: int) -> DataFrame:
    """(id, shingles, weights) of the documents of the blocks, packed."""
    def weigh(frame: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        weights, rows = Weights(answers, documents), []
        if len(frame):
            for id_, (own, _) in zip(frame["id"], shingler(words).of(frame["text"].tolist())):
                found, weight = weights.of(own)
                rows.append((id_, found.astype("<u8").tobytes(), weight.astype("<f4").tobytes()))
        return pd.DataFrame(rows, columns=["id", "shingles", "weights"])

    return (blocks.groupBy("block").cogroup(counts.groupBy("block"))
            .applyInPandas(lambda frame, answers: lean(weigh, frame, answers), "id long, shingles binary, weights binary"))


def verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose weighted Jaccard similarity is at least ``least``."""
    side = lambda name: sets.select(F.col("id").alias(name), F.struct("shingles", "weights").alias(f"set_{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a")
    flat = joined.select("a", "b", *(F.col(f"set_{s}.{c}").alias(f"{c}_{s}") for s in "ab" for c in ("shingles", "weights")))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (sa, wa, sb, wb) in enumerate(zip(*batch.columns[2:])):
                values = [np.frombuffer(v.as_buffer(), kind) for v, kind in
                          zip((sa, wa, sb, wb), ("<u8", "<f4", "<u8", "<f4"))]
                if similarity(*values) >= least:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)], ["a", "b"])

    return flat.mapInArrow(check, "a long, b long")


def bucket_links(frame: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links (a, b) that join the components of one bucket, at most one less than it has rows.

    An inverted index gives a row's shared weight with all others at once.  Every pair of two
    components has a row outside the largest of them, so only those rows are compared.
    """
    nodes, label = frame["node"].to_numpy(), frame["component"].to_numpy().copy()
    sets = [np.frombuffer(s, "<u8") for s in frame["shingles"]]
    sizes = np.array([len(s) for s in sets])
    weight = np.concatenate([np.frombuffer(w, "<f4") for w in frame["weights"]]).astype(np.float64)
    row = np.repeat(np.arange(len(sets)), sizes)
    total = np.bincount(row, weight, len(sets))
    hashes = np.concatenate(sets)
    order = np.argsort(hashes, kind="stable")
    first = np.flatnonzero(np.r_[True, hashes[order][1:] != hashes[order][:-1]])
    length = np.diff(first, append=len(order))
    group = np.empty(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(first)), length)
    there, there_weight = row[order], weight[order]
    ends, found = np.cumsum(sizes), []
    names, members = np.unique(label, return_counts=True)
    for i in np.flatnonzero(label != names[members.argmax()]):
        own = np.arange(ends[i] - sizes[i], ends[i])
        own = own[length[group[own]] > 1]
        times = length[group[own]]
        at = ranges(first[group[own]], times)
        shared = np.bincount(there[at], np.minimum(there_weight[at], np.repeat(weight[own], times)), len(sets))
        for j in np.flatnonzero(shared >= least * (total[i] + total - shared)):
            if label[i] != label[j]:
                found.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def links_across(members: DataFrame, groups: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """Links (a, b) between different components that share a bucket.

    A bucket's weighted sets meet in one task; a bucket of more than ``BUCKET_SHINGLES`` is dealt
    into blocks of which every two meet.
    """
    placed = written(members.join(groups, "node", "left")
                     .select("key", "node", F.coalesce("component", "node").alias("component")), "placed")
    sized = sets.select(F.col("id").alias("node"), (F.length("shingles") / 8).cast("long").alias("size"))
    mixed = written(placed.join(sized, "node").groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.ceil(F.sum("size") / BUCKET_SHINGLES).cast("int").alias("blocks"))
        .where("low < high").select("key", "blocks"), "mixed")
    dealt = (placed.join(mixed, "key")
             .withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("key", "node", "component", F.least("block", "other").alias("one"),
                     F.greatest("block", "other").alias("two")))
    return (dealt.join(sets.withColumnRenamed("id", "node"), "node").groupBy("key", "one", "two")
            .applyInPandas(lambda frame: lean(bucket_links, frame, least), "a long, b long"))


def near_duplicates(docs: DataFrame, config: Sampling = Sampling(), id_column: str = "doc_id",
                    text_column: str = "text") -> DataFrame:
    """(id, class_id, kept) of every row; the class is named by its smallest id."""
    with intermediates(docs.sparkSession):
        found = written(_classes_of(docs, config, id_column, text_column), "classes-of-documents", result=True)
    return (docs.select(F.col(id_column).cast("long").alias("id")).join(found, "id", "left")
            .select(F.col("id").alias(id_column), F.coalesce("class_id", "id").alias("class_id"))
            .withColumn("kept", F.col(id_column).eqNullSafe(F.col("class_id"))))


def _classes_of(docs: DataFrame, config: Sampling, id_column: str, text_column: str) -> DataFrame:
    """(id, class_id) of the documents with words."""
    spark = docs.sparkSession
    texts = (docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
             .where("id is not null and text is not null"))
    size = texts.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).first()
    n_blocks = parts_for(spark, size["chars"], BLOCK_CHARS)
    n_buckets = parts_for(spark, size["chars"], BUCKET_CHARS)
    blocks = _blocks(texts, n_blocks)
    counts = written(document_counts(blocks, config.words, n_buckets), "shingle-counts", release=True)
    signed = written(signatures(blocks, counts, size["n"], config), "signatures", release=True)

    classes = written(signed.groupBy("words", "size").agg(F.min("id").alias("node"), F.min_by("keys", "id").alias("keys")),
                      "classes")
    keyed = classes.select("node", F.explode("keys").alias("key"))
    buckets = written(keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
                      .where("first < last"), "bucket-heads")
    members = written(keyed.join(buckets, "key").select("key", "first", "node"), "buckets")
    some = written(members.select("node").distinct().select(F.col("node").alias("id")), "candidates")
    chosen = _blocks(join_small(texts, some, "id", "left_semi", FEW), n_blocks)
    sets = written(weighted_sets(chosen, counts, size["n"], config.words).dropDuplicates(["id"]), "weighted-sets", release=True)

    stars = written(members.where("first != node").select(F.col("first").alias("a"), F.col("node").alias("b"))
                    .distinct(), "pairs")
    links = written(verified(stars, sets, config.bar), "links", release=True)
    groups = written(components(links), "components")
    more = written(links_across(members, groups, sets, config.bar), "links", release=True)
    if not more.isEmpty():
        groups = written(components(links.unionByName(more)), "components")

    named = written(classes.join(groups, "node", "left")
                    .select("words", "size", F.coalesce("component", "node").alias("class_id")), "class-names")
    return signed.join(named, ["words", "size"]).groupBy("id").agg(F.min("class_id").alias("class_id"))


def one_of_each(docs: DataFrame, config: Sampling = Sampling(), id_column: str = "doc_id",
                text_column: str = "text") -> DataFrame:
    """``docs`` with one document of each class; of repeated rows of one id one stays.

    Rows without an id all stay.
    """
    found = written(near_duplicates(docs, config, id_column, text_column), "near-duplicates")
    dropped = found.where("not kept").select(id_column).distinct()
    kept = join_small(docs, dropped, id_column, "left_anti", FEW)
    repeated = written(found.where(F.col(id_column).isNotNull()).groupBy(id_column).count().where("count > 1")
                       .select(id_column), "repeated")
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, id_column, "left_anti").unionByName(
        kept.join(repeated, id_column, "left_semi").dropDuplicates([id_column]))
