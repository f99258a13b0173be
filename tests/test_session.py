"""The shared folder: required on a cluster, scratch tables deleted on request."""

import os

import pytest

from claimlens import session
from claimlens.operators.common import materialize


class _Conf:
    def __init__(self, master, folder=None):
        self.values = {"spark.master": master, "spark.checkpoint.dir": folder}

    def get(self, key, default=None):
        value = self.values.get(key)
        return default if value is None else value


class _Spark:
    def __init__(self, *args):
        self.conf = _Conf(*args)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.shared_dir(_Spark(master))
    assert session.shared_dir(_Spark(master, "hdfs:///x")) == "hdfs:///x"


def test_scratch_tables_are_deleted_at_the_end_of_the_scope(spark):
    with session.scratch_scope(spark):
        df = materialize(spark.range(5), "scope")
        path = df.inputFiles()[0].removeprefix("file://")
        assert df.count() == 5 and os.path.exists(path)
    assert not os.path.exists(path)
