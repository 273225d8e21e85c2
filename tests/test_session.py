import os

import pytest

from reelframe import scratch_path, scratch_scope, scratch_table, session, sized_for
from reelframe.session import drop_scratch


class FakeConf:
    def __init__(self, root):
        self.root = root

    def get(self, key, default=None):
        return self.root if key == "spark.checkpoint.dir" and self.root else default


class FakeSession:
    def __init__(self, root, master):
        self.conf = FakeConf(root)
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"


def test_scratch_is_where_the_session_says(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{root}/reelframe-{spark.sparkContext.applicationId}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession(None, "yarn"))
    assert session.shared_folder(FakeSession("hdfs://shared/x/", "yarn")) == "hdfs://shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(FakeSession(None, "local-cluster[2,1,1024]"))
    local = FakeSession(None, "local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)


def test_dropped_scratch_is_gone(spark):
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    drop_scratch(spark, path)
    assert not os.path.exists(path)
    assert os.path.exists(os.path.dirname(path))


def test_shuffle_parts_follow_the_data():
    def parts(size):
        return int(sized_for(size)["spark.sql.shuffle.partitions"])

    assert parts(10**6) == 200
    assert parts(2**40) == 4096
    assert parts(100 * 10**12) == -(-(100 * 10**12) // 2**28)


def test_scratch_is_empty_after_its_scope(spark):
    folder = os.path.dirname(scratch_path(spark, "outside"))
    scratch_table(spark, "t")
    before = set(os.listdir(folder))
    with scratch_scope(spark):
        path = scratch_path(spark, "inside")
        spark.range(20).write.parquet(path)
        assert scratch_table(spark, "t").startswith("reelframe_")
        assert os.path.basename(path) in set(os.listdir(folder)) - before
    assert set(os.listdir(folder)) == before


class Builder:
    def __init__(self):
        self.seen = {}

    def appName(self, name):
        return self

    def config(self, key, value):
        self.seen[key] = value
        return self

    def getOrCreate(self):
        return self.seen


def test_shuffles_start_from_many_parts_unless_told(monkeypatch):
    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert session.build_session()[first] == "4096"
    monkeypatch.setattr(session.SparkSession, "builder", Builder())
    assert first not in session.build_session(**{"spark.sql.shuffle.partitions": "8"})
