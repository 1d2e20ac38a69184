"""Packing token sequences into bins of fixed capacity by large-item matching and best fit.

All that matters for packing is how many pieces have each length, so the plan is made from the
counts per length: at most ``capacity`` rows, whatever the data size.  Pieces above a third of
the capacity meet at most one other such piece; the longest is matched with the longest that
fits.  Shorter pieces, longest first, go to the smallest gap that takes them, and open a bin
where none does.  The plan says which ranks of a length go to which bins; the pieces find their
rank inside their length by bucket, from counts per bucket.

Defined results: null text is empty and still has its end id; a piece that is repeated is packed
as often as it occurs; only documents longer than the capacity are cut, the first piece takes
what is over; an empty table gives no pieces.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from adrlens.llm.chunks import keeps_space, text_encoder
from adrlens.llm.common import free_name, parts_for, written

BUCKET_PIECES = 50_000
SLICE_BYTES = 1 << 20  # text encoded at once, so that a task needs little beside its cache


def piece_lengths(tokens: int, capacity: int) -> list[int]:
    pieces = max(1, -(-tokens // capacity))
    return [tokens - capacity * (pieces - 1)] + [capacity] * (pieces - 1)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int,
                 id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, piece, start, length, ids): ids of each piece as little-endian 32-bit numbers."""
    picked = docs.select(id_column, text_column)
    schema = T.StructType([picked.schema[id_column], T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer, keeps_space(tokenizer))
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at = 0
            for ids, counts in encoder.texts(batch.column(1), SLICE_BYTES):
                raw, begin = ids.astype("<u4").tobytes(), 0
                rows, pieces, starts, lengths, data = [], [], [], [], []
                for count in counts.tolist():
                    own = raw[begin:begin + 4 * count] + end
                    start, begin = 0, begin + 4 * count
                    for piece, length in enumerate(piece_lengths(count + 1, capacity)):
                        rows.append(at)
                        pieces.append(piece)
                        starts.append(start)
                        lengths.append(length)
                        data.append(own[4 * start:4 * (start + length)])
                        start += length
                    at += 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(pieces, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(data, pa.binary())], schema.names)

    return picked.mapInArrow(cut, schema)


class Plan:
    """Bins for pieces known by length and rank only."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.capacity, self.bins = capacity, 0
        self.places: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # rank, bin, offset
        self.rank: dict[int, int] = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens: first bin, bins
        self._match_large({n: c for n, c in counts.items() if 3 * n > capacity})
        for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
            self._best_fit(length, counts[length])

    def _open(self, bins: int) -> int:
        self.bins += bins
        return self.bins - bins

    def _place(self, length: int, bins: int, first: int, offset: int) -> None:
        """The next ``bins`` pieces of a length, one to each of consecutive bins."""
        self.places[length].append((self.rank[length], first, offset))
        self.rank[length] += bins

    def _leave(self, free: int, first: int, bins: int) -> None:
        if bins and free:
            self.gaps[free].append((first, bins))

    def _match_large(self, left: dict[int, int]) -> None:
        for length in sorted(left, reverse=True):
            while left[length]:
                fits = [n for n, c in left.items() if n <= self.capacity - length
                        and c > (n == length)]
                partner = max(fits, default=0)
                bins = (left[length] if not partner else left[length] // 2 if partner == length
                        else min(left[length], left[partner]))
                first = self._open(bins)
                self._place(length, bins, first, 0)
                left[length] -= bins
                if partner:
                    self._place(partner, bins, first, length)
                    left[partner] -= bins
                self._leave(self.capacity - length - partner, first, bins)

    def _best_fit(self, length: int, left: int) -> None:
        while left:
            gap = min((g for g, groups in self.gaps.items() if g >= length and groups), default=0)
            if gap:
                first, bins = self.gaps[gap].pop()
            else:
                gap, bins = self.capacity, -(-left // (self.capacity // length))
                first = self._open(bins)
            each = min(gap // length, left)  # the smallest gap is the one just narrowed
            taken = min(bins, left // each)
            for i in range(each):
                self._place(length, taken, first, self.capacity - gap + i * length)
            left -= each * taken
            self._leave(gap - each * length, first, taken)
            self._leave(gap, first + taken, bins - taken)

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of the pieces of a length with the given ranks."""
        rank, first, offset = np.array(self.places[length], np.int64).T
        at = np.searchsorted(rank, ranks, "right") - 1
        return first[at] + ranks - rank[at], offset[at]


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` with sequence_id and offset; needs ``length`` from 1 to the capacity.

    Other columns pass through; any that have the two names are replaced.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset")
    names = pieces.columns
    bucket, rank = free_name(names, "bucket"), free_name(names, "rank")
    # Dealt out row by row, so that equal rows do not meet in one bucket; written, so that it stays.
    pieces = written(pieces.withColumn(bucket, F.xxhash64(F.monotonically_increasing_id())), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = Plan(counts, capacity)  # bounded by the capacity
    buckets = parts_for(spark, sum(counts.values()), BUCKET_PIECES)
    pieces = pieces.withColumn(bucket, F.pmod(F.col(bucket), F.lit(buckets)).cast("int"))
    earlier = W.partitionBy("length").orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    ranks = (pieces.groupBy(bucket, "length").agg(F.count("*").alias(rank))
             .withColumn(rank, F.coalesce(F.sum(rank).over(earlier), F.lit(0)))
             .select(*(F.col(c).alias(c) for c in (bucket, "length", rank))))  # apart from the pieces' own columns
    schema = T.StructType([*(pieces.schema[n] for n in names), T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(own: pd.DataFrame, ranks: pd.DataFrame) -> pd.DataFrame:
        length = own["length"].to_numpy()
        first = dict(zip(ranks["length"], ranks[rank]))
        sequence, offset = np.zeros((2, len(own)), np.int64)
        order = np.argsort(length, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if len(rows):
                n = int(length[rows[0]])
                sequence[rows], offset[rows] = plan.find(n, first[n] + np.arange(len(rows)))
        return own[names].assign(sequence_id=sequence, offset=offset)

    return (pieces.groupBy(bucket).cogroup(ranks.groupBy(bucket))
            .applyInPandas(place, schema))
