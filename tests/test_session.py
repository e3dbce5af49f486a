"""Scratch-folder rules: shared folder required on clusters, Connect-safe."""

import os

import pytest

from mercato import session
from mercato.session import ensure_checkpoint_dir, remove_scratch, scratch_path


class _Conf:
    def __init__(self, values):
        self.values = dict(values)

    def get(self, key, default=None):
        return self.values.get(key, default)

    def set(self, key, value):
        self.values[key] = value


class _ConnectLike:
    """A session without a SparkContext, as with Spark Connect."""

    def __init__(self, values):
        self.conf = _Conf(values)

    @property
    def sparkContext(self):
        raise RuntimeError("no SparkContext on a Connect session")


def test_cluster_without_checkpoint_dir_is_an_error():
    with pytest.raises(ValueError, match="shared storage"):
        ensure_checkpoint_dir(_ConnectLike({"spark.master": "yarn"}))


@pytest.mark.parametrize("master", ["local-cluster[3,2,1024]", "spark://host:7077", ""])
def test_no_local_folder_for_separate_executors(master):
    with pytest.raises(ValueError, match="shared storage"):
        ensure_checkpoint_dir(_ConnectLike({"spark.master": master}))


def test_configured_folder_is_used_as_is():
    s = _ConnectLike({"spark.master": "yarn", "spark.checkpoint.dir": "hdfs:///shared/ckpt", "spark.app.id": "app-1"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"
    assert scratch_path(s, "x").startswith("hdfs:///shared/ckpt/mercato/x-")


def test_scratch_is_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "ensure_checkpoint_dir", lambda spark: str(tmp_path))
    path = scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(path)
    remove_scratch(spark)
    assert not os.path.exists(path) and os.path.isdir(tmp_path)


def test_local_session_keeps_its_configured_folder(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
