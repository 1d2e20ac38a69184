"""Token files: one wavelet matrix per shard, written and read as Parquet rows.

A shard holds the ids of consecutive documents in ascending id order.  Its wavelet matrix keeps
one bit per id and bit plane, highest bit first; below each plane the ids with bit 0 come before
those with bit 1.  With the number of set bits before each block of a plane, one file answers
access (the id at a position), rank (how often an id occurs before a position) and select (the
position of an id's n-th occurrence), and gives back whole documents.

File format: Parquet; one row per shard with part and shard (their order is the order of the
documents), n_tokens, n_bits, the documents' ids and lengths, and per plane the packed bits
and the number of zeros.  Counts per block are made on reading (cumulative sums of the bits).

Defined results: null text is empty and has its end id; null document ids come first; repeated
document ids stay next to each other; an empty table gives no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from adrlens.llm.chunks import keeps_space, text_encoder
from adrlens.llm.common import parts_for, written

SHARD_TOKENS = 1 << 17  # planes and positions of a shard stay in a core's cache
PART_TOKENS = 1 << 22  # ids of one task, some shards
BLOCK = 512  # bits between two stored counts of set bits


class WaveletMatrix:
    """Bit planes over a sequence of ids."""

    def __init__(self, planes: Sequence[bytes], zeros: Sequence[int], size: int):
        self.size, self.zeros = size, list(zeros)
        self.packed = [np.frombuffer(p, np.uint8) for p in planes]
        self._counts: list[np.ndarray | None] = [None] * len(self.packed)

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros = [], []
        for bit in range(bits - 1, -1, -1):
            on = (ids & ids.dtype.type(1 << bit)) != 0
            low = len(ids) - int(np.count_nonzero(on))
            below = np.empty_like(ids)
            np.compress(~on, ids, out=below[:low])
            np.compress(on, ids, out=below[low:])
            planes.append(np.packbits(on).tobytes())
            zeros.append(low)
            ids = below
        return cls(planes, zeros, len(ids))

    def ids(self) -> np.ndarray:
        """The whole sequence: the planes are undone from the lowest."""
        out = np.zeros(self.size, np.uint16 if len(self.packed) <= 16 else np.uint32)
        for bit, (packed, zeros) in enumerate(zip(reversed(self.packed), reversed(self.zeros))):
            on = np.unpackbits(packed, count=self.size).view(bool)
            below, out = out, np.empty_like(out)
            below[zeros:] |= out.dtype.type(1 << bit)
            out[np.flatnonzero(~on)] = below[:zeros]
            out[np.flatnonzero(on)] = below[zeros:]
        return out

    def _ones(self, plane: int, at: int) -> int:
        """Set bits of a plane before a position."""
        if self._counts[plane] is None:
            set_bits = np.bitwise_count(self.packed[plane])
            sums = np.concatenate([[0], np.cumsum(set_bits, dtype=np.int64)])
            self._counts[plane] = sums[::BLOCK // 8]
        block = at // BLOCK
        rest = np.unpackbits(self.packed[plane][block * BLOCK // 8:(at + 7) // 8], count=at - block * BLOCK)
        return int(self._counts[plane][block]) + int(rest.sum())

    def _is_set(self, plane: int, at: int) -> bool:
        return bool(self.packed[plane][at >> 3] >> (7 - (at & 7)) & 1)

    def access(self, at: int) -> int:
        """The id at a position."""
        found = 0
        for plane, zeros in enumerate(self.zeros):
            on, ones = self._is_set(plane, at), self._ones(plane, at)
            found = found << 1 | on
            at = zeros + ones if on else at - ones
        return found

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """The run of a token's occurrences before ``end`` below the last plane."""
        bits, begin = len(self.packed), 0
        if token >> bits:
            return 0, 0
        for plane, zeros in enumerate(self.zeros):
            first, last = self._ones(plane, begin), self._ones(plane, end)
            on = token >> (bits - 1 - plane) & 1
            begin, end = (zeros + first, zeros + last) if on else (begin - first, end - last)
        return begin, end

    def rank(self, token: int, end: int) -> int:
        """How often a token occurs before a position."""
        begin, stop = self._range(token, end)
        return stop - begin

    def count(self, token: int) -> int:
        return self.rank(token, self.size)

    def occurrences(self, token: int) -> np.ndarray:
        """All positions of a token: its run, led back up through the planes."""
        begin, end = self._range(token, self.size)
        at = np.arange(begin, end)
        for packed, zeros in zip(reversed(self.packed), reversed(self.zeros)):
            if not len(at):
                break
            on = np.unpackbits(packed, count=self.size).view(bool)
            at = np.flatnonzero(on)[at - zeros] if at[0] >= zeros else np.flatnonzero(~on)[at]
        return at

    def select(self, token: int, nth: int) -> int:
        """Position of the nth occurrence, from 0."""
        return int(self.occurrences(token)[nth])


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, id_column: str = "doc_id",
                     text_column: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids): 32-bit little-endian ids of each document with its end id."""
    picked = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    schema = T.StructType([picked.schema["doc_id"], T.StructField("n_tokens", T.LongType()),
                           T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer, keeps_space(tokenizer))
        for batch in batches:
            at = 0
            for ids, counts in encoder.texts(batch.column(1)):
                width = 2 if max(int(ids.max(initial=0)), end_id) < 1 << 16 else 4
                raw, begin = ids.astype(f"<u{width}").tobytes(), 0
                end, data = end_id.to_bytes(width, "little"), []
                for count in counts.tolist():
                    data.append(raw[begin:begin + width * count] + end)
                    begin += width * count
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(counts)), pa.array(counts + 1, pa.int64()),
                     pa.array(np.full(len(counts), width, np.int32)), pa.array(data, pa.binary())],
                    schema.names)
                at += len(counts)

    return picked.mapInArrow(encode, schema)


SHARD = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("shard", T.IntegerType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("n_bits", T.IntegerType()),
    T.StructField("doc_ids", T.ArrayType(T.LongType())), T.StructField("lengths", T.ArrayType(T.LongType())),
    T.StructField("zeros", T.ArrayType(T.LongType())), T.StructField("planes", T.ArrayType(T.BinaryType()))])


def _shard_row(shard: int, part: int, docs: list, lengths: list[int], data: list[np.ndarray]) -> pa.RecordBatch:
    ids = np.concatenate(data)
    matrix = WaveletMatrix.of(ids, max(1, int(ids.max()).bit_length()))
    columns = [[part], [shard], [len(ids)], [len(matrix.zeros)], [docs], [lengths], [matrix.zeros],
               [[p.tobytes() for p in matrix.packed]]]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()),
             pa.list_(pa.int64()), pa.list_(pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], SHARD.names)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int,
                      shard_tokens: int = SHARD_TOKENS, id_column: str = "doc_id",
                      text_column: str = "text") -> None:
    """Encode documents with integer ids and write one wavelet matrix per shard below ``path``."""
    spark = docs.sparkSession
    encoded = written(encode_documents(docs, tokenizer, end_id, id_column, text_column), "encoded")
    total = encoded.agg(F.sum("n_tokens")).first()[0] or 0
    ordered = (encoded.withColumn("doc_id", F.col("doc_id").cast("long"))
               .withColumn("tie", F.xxhash64("ids"))
               .repartitionByRange(parts_for(spark, total, PART_TOKENS), "doc_id", "tie")
               .sortWithinPartitions("doc_id", "tie")
               .select("doc_id", "width", "ids", F.spark_partition_id().alias("part")))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = held = part = 0
        docs, lengths, data = [], [], []
        for batch in batches:
            for doc, width, raw, part in zip(*(c.to_pylist() for c in batch.columns)):
                ids = np.frombuffer(raw, f"<u{width}")
                if held and held + len(ids) > shard_tokens:
                    yield _shard_row(shard, part, docs, lengths, data)
                    shard, held, docs, lengths, data = shard + 1, 0, [], [], []
                docs.append(doc)
                lengths.append(len(ids))
                data.append(ids)
                held += len(ids)
        if docs:
            yield _shard_row(shard, part, docs, lengths, data)

    ordered.mapInArrow(build, SHARD).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """(part, shard, start): tokens before each shard, from one narrow row per shard."""
    sizes = shards.select("part", "shard", "n_tokens")
    inside = W.partitionBy("part").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per part
    parts = parts.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("earlier"))
    return (sizes.withColumn("own", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(parts, "part").select("part", "shard", (F.col("earlier") + F.col("own")).alias("start")))


def _matrix(row: dict) -> WaveletMatrix:
    return WaveletMatrix(row["planes"], row["zeros"], row["n_tokens"])


def read_documents(spark: SparkSession, path: str, digests: bool = False) -> DataFrame:
    """(doc_id, part, shard, own, n_tokens, ids) of every document, from the files.

    ``own``: tokens before it in its shard; ids as 32-bit little-endian numbers.  With
    ``digests`` the ids stay in their task and ids_crc32 takes their place.
    """
    shards = read_shards(spark, path)
    last, kind = ("ids_crc32", pa.int64()) if digests else ("ids", pa.binary())
    keep = zlib.crc32 if digests else bytes

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, lengths = _matrix(row).ids().astype("<u4"), np.array(row["lengths"], np.int64)
                raw, ends = memoryview(ids).cast("B"), np.cumsum(lengths)
                own = [keep(raw[4 * (end - n):4 * end]) for end, n in zip(ends.tolist(), row["lengths"])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(ends), pa.int32()),
                     pa.array([row["shard"]] * len(ends), pa.int32()), pa.array(ends - lengths, pa.int64()),
                     pa.array(lengths, pa.int64()), pa.array(own, kind)],
                    ["doc_id", "part", "shard", "own", "n_tokens", last])

    return shards.mapInArrow(decode, "doc_id long, part int, shard int, own long, n_tokens long, "
                             + ("ids_crc32 long" if digests else "ids binary"))


def with_starts(documents: DataFrame, shards: DataFrame) -> DataFrame:
    """Documents read from the files, with ``start``: the ids of all documents before each."""
    return (documents.join(shard_starts(shards), ["part", "shard"])
            .withColumn("start", F.col("start") + F.col("own")).drop("part", "shard", "own"))


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(part, shard, n): occurrences of a token per shard, by rank alone."""
    def count(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pydict({"part": [row["part"]], "shard": [row["shard"]],
                                                  "n": [_matrix(row).count(token)]},
                                                 pa.schema([("part", pa.int32()), ("shard", pa.int32()),
                                                            ("n", pa.int64())]))

    return read_shards(spark, path).mapInArrow(count, "part int, shard int, n long")


def find_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """(doc_id, position) of every occurrence of a token, by rank and select."""
    def find(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = _matrix(row).occurrences(token)
                ends = np.cumsum(np.array(row["lengths"], np.int64))
                doc = np.searchsorted(ends, at, "right")
                begin = ends[doc] - np.array(row["lengths"], np.int64)[doc]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": [row["doc_ids"][d] for d in doc], "position": at - begin},
                    pa.schema([("doc_id", pa.int64()), ("position", pa.int64())]))

    return read_shards(spark, path).mapInArrow(find, "doc_id long, position long")
