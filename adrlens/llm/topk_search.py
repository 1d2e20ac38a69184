"""Exact top-k by inner product: columnar branch and bound.

Queries and candidates are dealt into blocks; every block of queries meets every block of
candidates in a task of its own, whose size does not depend on the data.  Inside a task the
candidates lie dimension by dimension.  For a block of queries the products are added up one
block of dimensions at a time; what the dimensions to come can still add is at most the product
of the remaining masses (norms) of query and candidate.  Candidates whose bound is below the
k-th best guaranteed score are dropped and the columns compacted before the next block.

Scores are integers: components are floor(scale * x).  While all components stay below 2^20 (and
there are at most 8,192) sums of products are exact in doubles.  Other pairs are scored in doubles
with a bound on the rounding, and what may be among the k best is scored in whole numbers.

Defined results: vectors that are null or empty, or hold components that are null or not finite
(after scaling) take no part; a score that does not fit a long is no result; vectors of another
length than the query are no candidates; rows without an id take no part; a repeated id is a
candidate as often as it occurs, but never for itself; ties go to the smaller id.  A query row that
is repeated is searched once; a query id with differing vectors is searched with each of them and
has k rows for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from adrlens.llm.common import shuffle_partitions, written
from adrlens.llm.vectors import matrix, usable

QUERY_BLOCK = 4_096
CANDIDATE_BLOCK = 32_768
DIMENSIONS = 8
LARGEST = 1 << 20  # components and
MOST_DIMENSIONS = 8_192  # lengths up to which doubles are exact
LONG = float(1 << 63)


def scaled(vector: Column, scale: int) -> Column:
    def whole(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)  # whole already

    return F.transform(vector, whole)


def remaining_mass(columns: np.ndarray, step: int) -> np.ndarray:
    """Norms of what follows each block of dimensions; one row per block."""
    squares = [np.square(columns[d:d + step]).sum(0) for d in range(0, len(columns), step)]
    after = np.cumsum([np.zeros(columns.shape[1]), *reversed(squares)], axis=0)[::-1]
    return np.sqrt(after[1:])


def _kth(values: np.ndarray, k: int) -> float:
    return -np.inf if len(values) < k else np.partition(values, len(values) - k)[len(values) - k]


def top_of_block(queries: np.ndarray, query_ids: np.ndarray, columns: np.ndarray, ids: np.ndarray,
                 k: int, step: int = DIMENSIONS) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query row, candidate ids, scores): the k best of a block of candidates, best first.

    ``columns``: dimensions x candidates; ``queries``: queries x dimensions.
    """
    masses, own = remaining_mass(columns, step), remaining_mass(queries.T.copy(), step)
    first = queries[:, :step] @ columns[:step]
    for row, (query, query_id) in enumerate(zip(queries, query_ids)):
        alive = np.flatnonzero(ids != query_id)
        sums = first[row][alive]
        for block, begin in enumerate(range(step, len(columns) + step, step)):
            if block:
                sums = sums + query[begin - step:begin] @ columns[begin - step:begin, alive]
            if begin >= len(columns):
                break
            rest = own[block][row] * masses[block][alive] * (1 + 1e-9)
            keep = sums + rest >= _kth(sums - rest, k)
            if not keep.all():
                alive, sums = alive[keep], sums[keep]
        order = np.lexsort((ids[alive], -sums))[:k]
        yield row, ids[alive][order], sums[order]


def top_of_large(queries: np.ndarray, query_ids: np.ndarray, columns: np.ndarray, ids: np.ndarray,
                 k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Like ``top_of_block``, for whole numbers of any size; scores that fit no long are left out."""
    with np.errstate(over="ignore", invalid="ignore"):
        sums = queries @ columns
        lengths = [np.sqrt(np.square(m).sum(axis)) for m, axis in ((queries, 1), (columns, 0))]
        errors = np.outer(*lengths) * ((len(columns) + 8) * 2.0 ** -51)
        unsure = ~np.isfinite(sums + errors)
    sums[unsure], errors[unsure] = 0, np.inf
    low, high = sums - errors, sums + errors
    fits, may_fit = (high < LONG / 2) & (low > -LONG / 2), (low < 2 * LONG) & (high > -2 * LONG)
    whole: dict[bytes, list[int]] = {}
    for row, (query, query_id) in enumerate(zip(queries, query_ids)):
        other = ids != query_id
        least = _kth(low[row][other & fits[row]], k)
        own, known, found = [int(x) for x in query], {}, []
        for at in np.flatnonzero(other & may_fit[row] & (high[row] >= least)):
            name = columns[:, at].tobytes()
            if name not in known:  # equal vectors are scored once
                numbers = whole.setdefault(name, [int(x) for x in columns[:, at]])
                known[name] = sum(a * b for a, b in zip(own, numbers))
            if -(1 << 63) <= known[name] < 1 << 63:
                found.append((-known[name], int(ids[at])))
        found = sorted(found)[:k]
        yield row, np.array([i for _, i in found], np.int64), np.array([-s for s, _ in found], np.int64)


def top_of_any(queries: np.ndarray, query_ids: np.ndarray, columns: np.ndarray, ids: np.ndarray,
               k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The k best of the pairs that doubles score exactly, and the k best of the others."""
    exact = len(columns) <= MOST_DIMENSIONS
    asks, small = (exact & (np.abs(m).max(axis) < LARGEST) for m, axis in ((queries, 1), (columns, 0)))
    for some, of, best_of in ((asks, small, top_of_block), (asks, ~small, top_of_large),
                              (~asks, np.ones(len(ids), bool), top_of_large)):
        if some.any() and of.any():
            names = np.flatnonzero(some)
            own = columns if of.all() else np.ascontiguousarray(columns[:, of])
            for row, best, scores in best_of(queries[some], query_ids[some], own, ids[of], k):
                yield names[row], best, scores


def top_k(vectors: DataFrame, is_query: Column, k: int, scale: int = 256, id_column: str = "vec_id",
          vector_column: str = "embedding", query_block: int = QUERY_BLOCK,
          candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, id, score) of the k best other rows for every row where ``is_query``."""
    spark = vectors.sparkSession
    whole = scaled(F.col(vector_column), scale)
    finite = usable(F.col("v"))
    rows = written(vectors.where(usable(F.col(vector_column)) & F.col(id_column).isNotNull())
                   .select(F.col(id_column).cast("long").alias("id"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"), whole.alias("v")).where(finite)
                   .withColumn("dims", F.size("v")), "vectors")
    asking = written(rows.where("asks").select("id", "dims", "v").distinct()
                     .withColumn("vector", F.row_number().over(W.partitionBy("id").orderBy("v")).cast("long")), "queries")
    asked = max(1, -(-asking.count() // query_block))
    dealt = max(-(-rows.count() // candidate_block), -(-shuffle_partitions(spark) // asked), 1)
    queries = (asking.withColumn("qb", F.pmod(F.xxhash64("id"), F.lit(asked)))
               .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(dealt - 1)))))
    candidates = (rows.withColumn("cb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(dealt)).cast("int"))
                  .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asked - 1).cast("long")))))

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(queries) and len(candidates):
            own, ids = queries["id"].to_numpy(), candidates["id"].to_numpy()
            names = queries["vector"].to_numpy()
            columns = np.ascontiguousarray(matrix(candidates["v"]).T)
            asked = matrix(queries["v"])
            for begin in range(0, len(own), 64):
                part = slice(begin, begin + 64)
                for row, best, scores in top_of_any(asked[part], own[part], columns, ids, k):
                    found.append(pd.DataFrame({"query_id": own[begin + row], "vector": names[begin + row],
                                               "id": best, "score": scores.astype(np.int64)}))
        return pd.concat(found) if found else pd.DataFrame(
            {"query_id": [], "vector": [], "id": [], "score": []}, dtype="int64")

    key = ["dims", "qb", "cb"]
    best = (queries.groupBy(key).cogroup(candidates.groupBy(key))
            .applyInPandas(search, "query_id long, vector long, id long, score long"))
    order = W.partitionBy("query_id", "vector").orderBy(F.desc("score"), "id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_column), "score"))
