"""Shared folder, lifetime of stage tables, fingerprints."""

import os
import time

import pytest

from seriesguard import session
from seriesguard.plans import stages


class _Cluster:
    """A session on a cluster without a shared folder."""

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
        applicationId = "app"

        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def getConf():
            return {}

    class conf:  # noqa: N801
        @staticmethod
        def get(key):
            raise KeyError(key)


def test_cluster_without_shared_folder_fails():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Cluster)


def _files(df):
    return [f.removeprefix("file://") for f in df.inputFiles()]


def test_stage_tables_end_with_their_scope(spark):
    outer = session.materialize(spark.range(5).toDF("a"), "outer")
    with session.stage_scope(spark):
        inner = session.materialize(outer, "inner")
        files = _files(inner)
        assert inner.count() == 5 and all(map(os.path.exists, files))
    assert not any(map(os.path.exists, files))
    assert outer.count() == 5


def test_changed_table_gives_new_stages(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.range(3).write.parquet(path)
    build = lambda: spark.read.parquet(path)
    first = stages.stage(spark, str(tmp_path), "copy", build)
    assert stages.stage(spark, str(tmp_path), "copy", build) is first
    time.sleep(1.1)
    spark.range(7).write.mode("overwrite").parquet(path)
    assert stages.stage(spark, str(tmp_path), "copy", build).count() == 7


def test_grown_heap_is_collected_after_a_stage_table(spark, monkeypatch):
    asked, collect = [], session.collect_garbage
    monkeypatch.setattr(session, "collect_garbage", lambda s: asked.append(collect(s, 0.0)))
    assert session.materialize(spark.range(5).toDF("a"), "grown").count() == 5
    assert asked == [True] and not collect(spark, 1.0)
