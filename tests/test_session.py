"""The shared folder and written intermediate tables."""

import os
import threading

import pytest

from adrlens import session
from adrlens.schemas import REPORT_TABLES
from adrlens.sources.case_tables import CaseTables
from conftest import rows


def test_shared_folder_is_the_one_the_cluster_names(spark):
    named = spark.sparkContext.getConf().get(session.CHECKPOINT_KEY) or spark.conf.get(
        session.CHECKPOINT_KEY, None)
    folder = session.shared_folder(spark)
    assert named is None or folder == named.rstrip("/")
    assert session.shared_folder(spark) == folder
    assert spark.sparkContext.getCheckpointDir() is not None


def test_materialised_frame_no_longer_depends_on_its_source(spark, tmp_path):
    path = f"{tmp_path}/source"
    spark.range(10).write.parquet(path)
    kept = session.materialise(spark.read.parquet(path), "kept", spread=True)
    for name in os.listdir(path):
        os.truncate(f"{path}/{name}", 0)
    assert rows(kept) == [(i,) for i in range(10)]
    assert kept.inputFiles()[0].startswith(("file:", "hdfs:", "s3"))


def test_tables_are_built_on_first_use(spark):
    built = []

    def build(name):
        built.append(name)
        return spark.range(1)

    tables = CaseTables(**{t: (lambda t=t: build(t)) for t in REPORT_TABLES})
    changed = tables.map(lambda name, df: df)
    assert built == []
    assert changed.reac.count() == 1 and tables.reac.count() == 1
    assert built == ["reac"]
    with pytest.raises(AttributeError):
        tables.other
    with pytest.raises(ValueError):
        CaseTables(demo=spark.range(1))


def test_intermediates_go_with_their_owner(spark):
    with session.intermediates(spark):
        kept = session.materialise(spark.range(5), "kept")
        with pytest.raises(ZeroDivisionError):
            with session.intermediates(spark):
                inner = session.materialise(spark.range(3), "inner")
                1 / 0
        assert kept.count() == 5
        with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
            spark.read.parquet(inner.inputFiles()[0]).count()
        path = kept.inputFiles()[0]
    with pytest.raises(Exception, match="FILE_NOT_EXIST|PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path).count()


def test_concurrent_calls_share_no_local_properties(spark):
    context, meet = spark.sparkContext, threading.Barrier(4, timeout=30)

    def work(i):
        inherited = context.getLocalProperty("adrlens.caller")
        context.setLocalProperty("adrlens.own", str(i))
        meet.wait()
        return inherited, context.getLocalProperty("adrlens.own")

    context.setLocalProperty("adrlens.caller", "here")
    try:
        assert session.concurrently(spark, work, range(4), 4) == [("here", str(i)) for i in range(4)]
        assert session.concurrently(spark, work, [], 4) == []
    finally:
        context.setLocalProperty("adrlens.caller", None)
