"""Ranked lexical search of many items over all documents by dense blocked matrix products.

1. Documents are cut into terms once: how often each term of the items occurs in a document, and
   the document's length.  These compact rows are written; counts over all documents follow.
2. Items form tiles; a tile has the compact vocabulary of its items.  The weights of a tile
   (items x terms) meet the impacts of a tile of documents (terms x documents) in one BLAS
   product of doubles.  All values are whole numbers.  The vocabulary is cut into blocks so
   short that no partial sum reaches 2^53; the blocks' sums are added as 64-bit integers.
3. A task keeps the ``k`` best per item: only scores at or above the item's floor, the k-th best
   so far, go on, equal ones too, so that ties fall by document id and not by chance.  The tasks'
   rows meet in one window per item.

Only items are held by the driver, ``SLAB_TERMS`` of their terms at a time; more items are
searched slab after slab against all documents.

Defined results: items are named by their id; the texts of rows that share one are one item;
items without id, text or term find nothing.  Each row of documents is ranked, so repeated rows
take a rank each; a document without an id comes after all others of its score; documents
without a term (null, empty, signs only) count nowhere; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from adrlens.llm.chunks import array_slices
from adrlens.llm.common import written

SLAB_TERMS = 1 << 20  # (item, term) pairs searched in one pass
TILE_ITEMS = 256
TILE_CELLS = 1 << 22  # of a tile's impacts: terms of a block x documents
BLOCK_TERMS = 1 << 12
EXACT = 1 << 53  # doubles hold whole numbers below
NO_ID = np.iinfo(np.int64).max


def _folding() -> np.ndarray:
    """Byte table: ASCII letters and digits and all other characters' bytes are kept, A-Z in lower
    case; what separates terms becomes a blank."""
    table = np.full(256, ord(" "), np.uint8)
    for first, last in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        table[first:last + 1] = np.arange(first, last + 1)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    return table


FOLDED = _folding()


def split_terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(row of each term, terms) of texts without nulls, in order."""
    if not len(texts):
        return np.empty(0, np.int64), pa.array([], pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = FOLDED[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]]
    plain = pa.StringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).astype(np.int32)), pa.py_buffer(data))
    lists = pc.split_pattern(plain, " ")
    rows = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy())
    terms = lists.flatten()
    real = pc.greater(pc.binary_length(terms), 0)
    return rows[real.to_numpy(zero_copy_only=False)], terms.filter(real)


def as_strings(texts: pa.Array) -> pa.Array:
    return texts.cast(pa.string()) if texts.type != pa.string() else texts


def item_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(item, term), distinct."""
    own = items.select(F.col(id_column).cast("long").alias("item"), F.col(text_column).cast("string").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in array_slices(as_strings(batch.column(1))):
                rows, terms = split_terms(texts)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at + rows)), terms], ["item", "term"])
                at += len(texts)

    return own.where("item is not null and text is not null").mapInArrow(cut, "item long, term string").distinct()


def occurrences(docs: DataFrame, vocabulary: list[str], id_column: str, text_column: str) -> DataFrame:
    """(id, n, terms, times) of documents with a term: numbers of vocabulary terms and their counts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # at most SLAB_TERMS
    own = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(shared.value, pa.string())
        for batch in batches:
            at = 0
            for texts in array_slices(as_strings(batch.column(1))):
                rows, terms = split_terms(texts)
                n = np.bincount(rows, minlength=len(texts))
                coded = terms.dictionary_encode()
                numbers = pc.fill_null(pc.index_in(coded.dictionary, known), -1).to_numpy()[coded.indices.to_numpy()]
                hit = numbers >= 0
                cell, times = np.unique(rows[hit] * len(known) + numbers[hit], return_counts=True)
                ends = np.searchsorted(cell // max(1, len(known)), np.arange(len(texts) + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
                         for values in (cell % max(1, len(known)), times)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), *lists],
                    ["id", "n", "terms", "times"]).filter(pa.array(n > 0))
                at += len(texts)

    return own.mapInArrow(count, "id long, n long, terms array<int>, times array<int>")


def document_counts(found: DataFrame, terms: int) -> np.ndarray:
    """Number of documents of each vocabulary term."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(terms, np.int64)
        for batch in batches:
            own += np.bincount(batch.column(0).flatten().to_numpy(), minlength=terms)
        some = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(own[some])], ["term", "df"])

    counts = np.zeros(terms, np.int64)
    for row in found.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        counts[row["term"]] = row["df"]  # as many rows as the vocabulary
    return counts


@dataclass
class Tile:
    """Items with their compact vocabulary: ``weights`` (items x terms) and the terms' numbers."""

    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def tiles_of(items: np.ndarray, terms: np.ndarray, weights: np.ndarray, size: int = TILE_ITEMS) -> Iterator[Tile]:
    """Tiles of (item, term) pairs; ``weights`` by term."""
    names, place = np.unique(items, return_inverse=True)
    for begin in range(0, len(names), size):
        inside = (place >= begin) & (place < begin + size)
        own, column = np.unique(terms[inside], return_inverse=True)
        cells = np.zeros((min(size, len(names) - begin), len(own)))
        cells[place[inside] - begin, column] = weights[own][column]
        yield Tile(names[begin:begin + size], own, cells)


def impacts(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // (1000 * times + 20 * m)


class Best:
    """The ``k`` best (score, id) of each item of a tile."""

    def __init__(self, items: int, k: int):
        self.k, self.floor = k, np.ones(items, np.int64)
        self.item, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of a tile of documents (items x documents)."""
        if scores.shape[1] > self.k:  # the tile's own k-th best is a floor, too
            kth = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            self.floor = np.maximum(self.floor, kth)
        item, at = np.nonzero(scores >= self.floor[:, None])
        if not len(item):
            return
        item, score = np.concatenate([self.item, item]), np.concatenate([self.score, scores[item, at]])
        id_ = np.concatenate([self.id, ids[at]])
        order = np.lexsort((id_, -score, item))
        item, score, id_ = item[order], score[order], id_[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        kept = rank < self.k
        self.item, self.score, self.id = item[kept], score[kept], id_[kept]
        last = rank == self.k - 1
        self.floor[item[last]] = score[last]


def block_terms(weights: np.ndarray, most_impact: int, limit: int = BLOCK_TERMS) -> int:
    """Terms of a block, so that no sum of their products reaches 2^53."""
    largest = max(1, int(weights.max(initial=0))) * max(1, most_impact)
    return max(1, min(limit, (EXACT - 1) // largest))


def scores_of(tile: Tile, dense: np.ndarray, block: int) -> np.ndarray:
    """Whole scores (items x documents) of a tile; ``dense``: impacts of its terms (terms x documents)."""
    total = np.zeros((len(tile.items), dense.shape[1]), np.int64)
    for begin in range(0, len(tile.terms), block):
        total += (tile.weights[:, begin:begin + block] @ dense[begin:begin + block]).astype(np.int64)
    return total


def best_of_tasks(found: DataFrame, tiles: list[Tile], terms: int, documents: int, length: int, k: int) -> DataFrame:
    """(item_id, id, score): per task and item its best documents."""
    shared = found.sparkSession.sparkContext.broadcast(tiles)  # made of at most SLAB_TERMS pairs

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        best = [Best(len(t.items), k) for t in tiles]
        blocks = [block_terms(t.weights, 1_000_000) for t in tiles]  # an impact is below a million
        place = np.full(terms, -1, np.int64)
        width = max(64, TILE_CELLS // max((len(t.terms) for t in tiles), default=1))
        for batch in batches:
            ids = pc.fill_null(batch.column(0), NO_ID).to_numpy()
            m = 100 - 50 + (50 * documents * batch.column(1).to_numpy()) // length
            lists = batch.column(2)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            term, times = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
            impact = impacts(times, np.repeat(m, np.diff(ends)))
            for begin in range(0, len(ids), width):
                end = min(begin + width, len(ids))
                own = slice(ends[begin], ends[end])
                column = np.repeat(np.arange(end - begin), np.diff(ends[begin:end + 1]))
                for tile, top, block in zip(tiles, best, blocks):
                    place[tile.terms] = np.arange(len(tile.terms))
                    row = place[term[own]]
                    hit = row >= 0
                    dense = np.zeros((len(tile.terms), end - begin))
                    dense[row[hit], column[hit]] = impact[own][hit]
                    top.add(scores_of(tile, dense, block), ids[begin:end])
                    place[tile.terms] = -1
        for tile, top in zip(tiles, best):
            ids = pa.array(top.id, mask=top.id == NO_ID)
            yield pa.RecordBatch.from_arrays([pa.array(tile.items[top.item]), ids, pa.array(top.score)], ["item_id", "id", "score"])

    return found.mapInArrow(search, "item_id long, id long, score long")


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.float64)


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", slab_terms: int = SLAB_TERMS) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    pairs = written(item_terms(items, item_column, item_text), "item-terms")
    n_slabs = max(1, -(-pairs.count() // slab_terms))
    results = None
    for slab in range(n_slabs):
        own = pairs.where(F.pmod(F.xxhash64("item"), F.lit(n_slabs)) == slab).toArrow()
        coded = pc.dictionary_encode(own.column("term").combine_chunks())
        vocabulary, number = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        found = written(occurrences(docs, vocabulary, id_column, text_column), "occurrences")
        totals = found.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        if not vocabulary or not totals["documents"]:
            continue
        weights = term_weights(totals["documents"], document_counts(found, len(vocabulary)))
        tiles = list(tiles_of(own.column("item").to_numpy(), number, weights))
        best = written(best_of_tasks(found, tiles, len(vocabulary), totals["documents"], totals["length"], k), "task-best")
        results = best if results is None else results.unionByName(best)
    if results is None:
        results = spark.createDataFrame([], "item_id long, id long, score long")
    order = W.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (results.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select(F.col("item_id").alias(item_column), "rank", F.col("id").alias(id_column), "score"))
