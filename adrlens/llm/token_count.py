"""Token counts of whole texts; huge documents by overlapping chunks that are spliced.

Texts up to ``chunk`` characters are encoded in their task.  A longer text is cut into chunks that
overlap by ``overlap`` characters and are spread over the cluster.  Each chunk is encoded with
offsets.  A position is a stable boundary when a visible character stands before it and a blank
or a line end at it: no pre-token and no added token reaches across, so the tokens on either side
are those of the whole text.  Two neighbours are spliced at the first stable position in their
overlap where both have a token boundary; a chunk then counts for the tokens between its two
splices.  Documents with an overlap without such a position are cut again with chunks and
overlaps four times as long, at the end into one chunk.

Defined results: null text is empty (0 bytes, 0 tokens); repeated rows, also of one id, are
counted each on its own; a null id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from adrlens.llm.chunks import keeps_space, library, text_encoder
from adrlens.llm.common import parts_for, written

CHUNK = 32_768
OVERLAP = 1_024
WIDER = 4


def chunk_starts(length: int, chunk: int, overlap: int) -> range:
    """Starts of chunks of ``chunk`` characters of which neighbours share ``overlap``."""
    return range(0, max(1, length - overlap), chunk - overlap)


def _cut(docs: DataFrame, tokenizer: str, chunk: int) -> DataFrame:
    """One row per text: counted if it is short, else with its text for later."""
    schema = T.StructType([docs.schema["row"], docs.schema["id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("text", T.StringType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = text_encoder(tokenizer, keeps_space(tokenizer))
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            huge = pc.greater(pc.utf8_length(texts), chunk)
            tokens = encoder.counts(pc.if_else(huge, "", texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pc.cast(pc.binary_length(texts), pa.int64()),
                 pc.if_else(huge, pa.scalar(None, pa.int64()), pa.array(tokens, pa.int64())),
                 pc.if_else(huge, texts, pa.scalar(None, texts.type))], schema.names)

    return docs.select("row", "id", "text").mapInArrow(count, schema)


def _chunks(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, piece, begin, last, part): the overlapping chunks of long texts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                starts = chunk_starts(len(text), chunk, overlap)
                for first in range(0, len(starts), 64):
                    own = starts[first:first + 64]
                    yield pa.RecordBatch.from_pydict({
                        "row": [row] * len(own), "piece": list(range(first, first + len(own))),
                        "begin": list(own), "last": [s == starts[-1] for s in own],
                        "part": [text[s:s + chunk] for s in own]},
                        pa.schema([("row", pa.int64()), ("piece", pa.int32()), ("begin", pa.int64()),
                                   ("last", pa.bool_()), ("part", pa.string())]))

    return long.select("row", "text").mapInArrow(
        cut, "row long, piece int, begin long, last boolean, part string")


def stable_cuts(part: str, offsets: np.ndarray, low: int, high: int) -> list[tuple[int, int]]:
    """(position, tokens before it) of the stable token boundaries in ``[low, high)``."""
    found = []
    for number in range(int(np.searchsorted(offsets, max(low, 1))),
                        int(np.searchsorted(offsets, high))):
        at = int(offsets[number])
        if at < len(part) and part[at] in " \n" and not part[at - 1].isspace():
            found.append((at, number))
    return found


def _encode(chunks: DataFrame, tokenizer: str, overlap: int) -> DataFrame:
    """Per chunk its tokens and the stable boundaries in the overlap on either side."""
    cut = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library(tokenizer)
        for batch in batches:
            left, right, tokens = [], [], []
            begins, lasts = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for begin, last, part in zip(begins, lasts, batch.column(4).to_pylist()):
                offsets = np.array([s for s, _ in encoder.encode(part, add_special_tokens=False).offsets]
                                   or [0], np.int64)
                near = [] if not begin else stable_cuts(part, offsets, 0, overlap)
                far = [] if last else stable_cuts(part, offsets, len(part) - overlap, len(part))
                left.append([{"at": begin + a, "before": n} for a, n in near])
                right.append([{"at": begin + a, "before": n} for a, n in far])
                tokens.append(len(offsets))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(tokens, pa.int64()),
                 pa.array(left, cut), pa.array(right, cut)],
                ["row", "piece", "last", "n_tokens", "near", "far"])

    return chunks.mapInArrow(encode, "row long, piece int, last boolean, n_tokens long, "
                             "near array<struct<at:long,before:long>>, far array<struct<at:long,before:long>>")


def _splice(encoded: DataFrame) -> DataFrame:
    """(row, n_tokens) of the documents; null where two neighbours share no boundary."""
    following = encoded.select("row", (F.col("piece") - 1).alias("piece"), F.col("near").alias("next"))
    both = F.filter("far", lambda f: F.exists("next", lambda n: n["at"] == f["at"]))
    joined = (encoded.join(following, ["row", "piece"], "left")
              .withColumn("cut", F.when(~F.col("last"), F.try_element_at(both, F.lit(1)))))
    same = F.filter("next", lambda n: n["at"] == F.col("cut.at"))
    until = F.when(F.col("last"), F.col("n_tokens")).otherwise(F.col("cut.before"))
    skipped = F.when(F.col("last"), 0).otherwise(F.try_element_at(same, F.lit(1))["before"])
    return (joined.groupBy("row").agg(F.sum(until - skipped).alias("n_tokens"),
                                      F.bool_or(until.isNull()).alias("failed"))
            .select("row", F.when(~F.col("failed"), F.col("n_tokens")).alias("n_tokens")))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int, chunk: int = CHUNK,
                 overlap: int = OVERLAP, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every document."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"),
                       F.col(text_column).alias("text"))
    first = written(_cut(rows, tokenizer, chunk), "counted")
    counted = first.where("n_tokens is not null").select("id", "n_bytes", "n_tokens")
    sizes = first.where("n_tokens is null").select("row", "id", "n_bytes")
    long = first.where("n_tokens is null").select("row", "text")
    span = long.agg(F.max(F.length("text")).alias("most"), F.sum(F.length("text")).alias("all")).first()
    left = bool(span["most"])
    while left:  # each round widens, up to one chunk for the longest text
        parts = parts_for(spark, span["all"], 1 << 20)
        pieces = _chunks(long, chunk, overlap).repartition(parts, "row", "piece")
        spliced = written(_splice(written(_encode(pieces, tokenizer, overlap), "chunks")), "spliced")
        failed = spliced.where("n_tokens is null").select("row")
        counted = counted.unionByName(sizes.join(spliced.where("n_tokens is not null"), "row").drop("row"))
        left = not failed.isEmpty()
        long = long.join(failed, "row", "left_semi")
        chunk, overlap = WIDER * chunk, WIDER * overlap
    return counted.select(F.col("id").alias(id_column), "n_bytes", "n_tokens",
                          (F.col("n_tokens") > limit).alias("over_limit"))
