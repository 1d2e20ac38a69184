"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # no call sites per column
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "adrlens", **conf: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    context = spark.sparkContext
    folder = context.getConf().get(CHECKPOINT_KEY) or spark.conf.get(CHECKPOINT_KEY, None)
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="adrlens-")
    context.setCheckpointDir(folder)
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def new_shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_OWNERS: list[list[str]] = []  # paths written inside the open blocks of ``intermediates``


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def own(path: str, outer: bool = False) -> None:
    """Leave a path to the open block of ``intermediates`` that is innermost, or the one around it."""
    if len(_OWNERS) > outer:
        _OWNERS[-1 - outer].append(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Owner of the tables that ``materialise`` writes inside the block: they go at its end."""
    paths: list[str] = []
    _OWNERS.append(paths)
    try:
        yield
    finally:
        _OWNERS.pop()
        for path in paths:
            remove_path(spark, path)


def materialise(df: DataFrame, name: str, spread: bool = False) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts lineage and survives the loss of executors; use it where several jobs read the
    same expensive result.  ``spread`` deals the rows out evenly, for readers whose cost is
    computation, not bytes: adaptive execution gives every core a share and splits what is
    above the advisory size.
    """
    spark = df.sparkSession
    if spread:
        df = df.hint("rebalance")
    path = new_shared_path(spark, name)
    own(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def concurrently(spark: SparkSession, work: Callable, items: Iterable, threads: int) -> list:
    """``work`` of each item, in order; up to ``threads`` at a time.

    Each call has a copy of the caller's local properties for itself: one that is shared breaks
    jobs now and then, as Spark keeps the number of a thread's query in it.
    """
    calls = [inheritable_thread_target(spark)(partial(work, item)) for item in items]
    with ThreadPool(max(1, min(threads, len(calls)))) as pool:
        return pool.map(lambda call: call(), calls, chunksize=1)
