"""Checkpoint-folder policy: shared folder from the session; a private one
only in local mode; a cluster without the setting is refused."""

import os

import pytest

from fixreg.session import ScratchSpace, close_session_space, ensure_checkpoint_dir, session_space


class _Conf(dict):
    def get(self, k, default=None):
        return super().get(k, default)


class _SC:
    def __init__(self, master, conf=None, current=None):
        self.master, self._conf, self.current = master, _Conf(conf or {}), current

    def getCheckpointDir(self):
        return self.current

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.current = d


class _Spark:
    def __init__(self, sc):
        self.sparkContext, self.conf = sc, _Conf()


def test_uses_configured_folder():
    s = _Spark(_SC("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"}))
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_local_gets_private_folder():
    s = _Spark(_SC("local[2]"))
    assert "fixreg-ckpt-" in ensure_checkpoint_dir(s)


def test_cluster_without_setting_is_refused():
    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(_Spark(_SC("spark://host:7077")))


def test_local_cluster_counts_as_a_cluster():
    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(_Spark(_SC("local-cluster[2,1,1024]")))


def folder(path):
    return path.removeprefix("file:")


def test_scratch_space_owns_its_tables(spark):
    with ScratchSpace(spark, "one") as one, ScratchSpace(spark, "two") as two:
        a, b = one.write(spark.range(5), "probe"), two.write(spark.range(7), "probe")
        one.drop("probe")
        assert b.count() == 7 and not os.path.exists(folder(a.inputFiles()[0] if a.inputFiles() else one.path + "/0-probe"))
        with pytest.raises(Exception, match="no such row"):
            two.write(spark.range(3).selectExpr("id", "CASE WHEN id = 2 THEN raise_error('no such row') ELSE id END AS x"), "bad")
        assert os.listdir(folder(two.path)) == ["0-probe"]
    assert not os.path.exists(folder(one.path)) and not os.path.exists(folder(two.path))


def test_session_space_is_closed_on_request(spark):
    path = session_space(spark).path
    assert session_space(spark).write(spark.range(2), "x").count() == 2
    close_session_space(spark)
    assert not os.path.exists(folder(path)) and session_space(spark).path != path
