"""work_dir: the cluster's folder wins; a local folder only when none is set."""

import os

import pytest

from dqspark.session import materialize, scratch_scope, work_dir


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, key, default=None):
        return self.d.get(key, default)


class _SC:
    def __init__(self, master="local[2]"):
        self.dir = None
        self.master = master

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return _Conf({})

    def setCheckpointDir(self, d):
        self.dir = d + "/uuid"


class _Session:
    def __init__(self, conf, sc):
        self.conf, self._sc = _Conf(conf), sc

    @property
    def sparkContext(self):
        if self._sc is None:
            raise RuntimeError("no SparkContext (Connect)")
        return self._sc


def test_cluster_setting_is_used():
    assert work_dir(_Session({"spark.checkpoint.dir": "hdfs://nn/shared/ckpt/"}, _SC())) == "hdfs://nn/shared/ckpt"


def test_local_folder_only_when_unset():
    sc = _SC()
    d = work_dir(_Session({}, sc))
    assert d.endswith("/uuid") and sc.dir == d


@pytest.mark.parametrize("session", [_Session({}, _SC("spark://host:7077")), _Session({}, _SC("local-cluster[2,1,1024]")), _Session({}, None)])
def test_no_machine_local_folder_on_a_cluster(session):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(session)


def test_scratch_scope_removes_what_was_made_inside(spark):
    kept = materialize(spark.range(5), "kept")
    with scratch_scope(spark):
        inner = materialize(spark.range(7), "inner")
        path = inner.inputFiles()[0]
        assert inner.count() == 7
    assert not os.path.exists(path.removeprefix("file://"))
    assert kept.count() == 5
