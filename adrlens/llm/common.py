"""Helpers of the operators: frames written once, text slices, size-checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from adrlens.session import new_shared_path, own, remove_path

_KEPT: dict[str, dict[str, tuple[object, object]]] = {}  # operator: kind: key, value


def kept_by_worker(operator: str, kind: str, key: object, build: Callable[[], object]) -> object:
    """What ``build`` gives, kept for the worker's next tasks.

    Of each kind the latest key's is kept.  Where another operator's task begins, all that the one
    before kept goes and its memory is given back, so the memories of successive operators do not
    add up in one worker.
    """
    if operator not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            _give_back()
        _KEPT[operator] = {}
    own = _KEPT[operator]
    if kind not in own or own[kind][0] != key:
        own.pop(kind, None)
        own[kind] = key, build()
    return own[kind][1]


def lean(work: Callable, *values):
    """What ``work`` gives; the memory that it freed goes back to the machine.

    Else a worker keeps the memory of its largest group while it waits for its next task.
    """
    try:
        return work(*values)
    finally:
        _trim()


def _give_back() -> None:
    """Hand free memory back to the machine, that of reference cycles, too."""
    gc.collect()
    _trim()


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


SLICE_CHARS = 1 << 21  # characters handled at once inside a task
FEW_PARTS = 500_000  # (group, partition) rows that may be broadcast
_PLACE = 1 << 33  # of a partition in monotonically_increasing_id


def written(df: DataFrame, name: str, release: bool = False, result: bool = False) -> DataFrame:
    """The frame, written to the shared folder and read back: several jobs read it, lineage ends.

    Inside a block of ``session.intermediates`` the table goes at the block's end; a ``result``
    outlives it and is left to the block around it, if there is one.  ``release`` asks Spark to drop the shuffle files of finished jobs, for a job that shuffled
    much, so that the next one has the disk.
    """
    spark = df.sparkSession
    path = new_shared_path(spark, name)
    own(path, outer=result)
    df.write.parquet(path)
    if release:
        release_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int, release: bool = False) -> DataFrame:
    """Like a result of ``written``, dealt out by ``key``: joins on it leave these rows where they are.

    It stays as long as the result is read, hence the closer compression.
    """
    spark, path = df.sparkSession, new_shared_path(df.sparkSession, name)
    own(path, outer=True)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("compression", "zstd").option("path", path).saveAsTable(table)
    if release:
        release_shuffles(spark)
    return spark.table(table)


def discard(*frames: DataFrame) -> None:
    """Remove tables that ``written`` gave, once nothing reads them any more."""
    for frame in frames:
        for folder in {file.rsplit("/", 1)[0] for file in frame.inputFiles()}:
            remove_path(frame.sparkSession, folder)


def release_shuffles(spark: SparkSession, pause: float = 0.5) -> None:
    """Spark's cleaner removes shuffle files once the driver has collected what refers to them.

    The last job's events still do so for a moment, hence the pause before.
    """
    for _ in range(2):
        gc.collect()
        time.sleep(pause)
        spark.sparkContext._jvm.System.gc()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_for(spark: SparkSession, amount: int, per_part: int) -> int:
    """Groups so that each holds about ``per_part`` of ``amount``, at least one per shuffle task."""
    return max(shuffle_partitions(spark), -(-int(amount) // per_part))


def text_slices(texts: Sequence[str], chars: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``chars`` characters; a longer text is alone."""
    begin = held = 0
    for i, text in enumerate(texts):
        if i > begin and held + len(text) > chars:
            yield begin, i
            begin, held = i, 0
        held += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each range, one range after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def join_small(left: DataFrame, right: DataFrame, on, how: str, max_rows: int) -> DataFrame:
    """Join that broadcasts ``right`` only after counting it; beyond ``max_rows`` it shuffles."""
    few = right.limit(max_rows + 1).count() <= max_rows
    return left.join(F.broadcast(right) if few else right, on, how)


def numbered(frame: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """(group, size, at) and the other columns: ``at`` counts the rows of a group in order, from 0.

    The rows are sorted by range, so that a large group lies on many partitions; a row's number is
    its place in its partition plus the group's rows on the partitions before.
    """
    placed = frame.withColumn("tie", F.monotonically_increasing_id())  # deals out rows that are all equal
    keys = [group, *order, "tie"]
    placed = written(placed.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie")
                     .withColumn("place", F.monotonically_increasing_id()), name)
    part = F.floor(F.col("place") / _PLACE).alias("part")
    inside = W.partitionBy(group)
    counts = (placed.groupBy(group, part).agg(F.count("*").alias("n"), F.min("place").alias("first"))
              .withColumn("before", F.sum("n").over(inside.orderBy("part")) - F.col("n") - F.col("first"))
              .withColumn("size", F.sum("n").over(inside)).select(group, "part", "before", "size"))
    counts = written(counts, name + "-counts")
    return (join_small(placed.withColumn("part", F.floor(F.col("place") / _PLACE)), counts, [group, "part"], "inner", FEW_PARTS)
            .withColumn("at", F.col("before") + F.col("place")).drop("part", "before", "place"))


def free_name(columns: Sequence[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
