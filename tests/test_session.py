"""Shared-folder handling and plan shapes the scale design relies on."""

import os
import tempfile
import threading

import pytest

from reviewlens import session as S
from reviewlens.operators import votes as V


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = conf
        self._dir = None

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d

    def getConf(self):
        return self._conf


class _Session:
    def __init__(self, master, values):
        self.conf = _Conf(values)
        self.sparkContext = _Context(master, _Conf(values))


def test_cluster_without_checkpoint_dir_raises():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Session("yarn", {}))


def test_named_checkpoint_dir_is_used():
    s = _Session("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert S.ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_fallback_only_when_unset():
    s = _Session("local[2]", {})
    assert S.ensure_checkpoint_dir(s).startswith(tempfile.gettempdir())


def test_local_cluster_is_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_Session("local-cluster[2,1,1024]", {}))


def test_written_partitions_are_pruned_and_removed(spark):
    path = S.shared_path(spark, "probe")
    df = S.written(spark.range(30).selectExpr("id", "cast(id % 3 as int) as part"), path, "part")
    assert df.columns == ["id", "part"] and df.filter("part = 1").count() == 10
    assert "PartitionFilters: [isnotnull(part" in df.filter("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert all(path.replace("file:", "") in f for f in df.inputFiles())
    S.remove_path(spark, path)
    assert not os.path.exists(path.replace("file:", ""))


def test_materialize_writes_below_checkpoint_dir(spark):
    base = S.ensure_checkpoint_dir(spark)
    df = S.materialize(spark.range(10), "probe")
    files = df.inputFiles()
    assert files and all(f.startswith(base.rstrip("/")) or base.replace("file:", "") in f for f in files)
    assert df.count() == 10


def test_vote_aggregate_is_partial_then_one_shuffle(spark):
    rows = [("hot", "1,1")] * 300 + [(f"r{i}", "2,1") for i in range(300)]
    df = spark.createDataFrame(rows, "reviewer string, helpful_str string").repartition(4)
    plan = V.helpful_rate(V.parse_votes(df))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_count" in plan
    got = {r.reviewer: r.review_count for r in V.helpful_rate(V.parse_votes(df)).collect()}
    assert got["hot"] == 300 and len(got) == 301


def test_threads_have_local_properties_of_their_own(spark):
    together = threading.Barrier(4)

    def own(i):
        spark.sparkContext.setLocalProperty("reviewlens.number", str(i))
        together.wait(60)
        return i, spark.sparkContext.getLocalProperty("reviewlens.number"), spark.range(i).count()

    assert S.in_threads(spark, own, range(4), 4) == [(i, str(i), i) for i in range(4)]
    assert S.in_threads(spark, own, [], 4) == []
