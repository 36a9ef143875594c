from types import SimpleNamespace

import pytest

from webfeed.session import scratch_dir


def _session(master, configured=None, current=None):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=lambda d: None)
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: configured))


def test_cluster_needs_shared_checkpoint_dir():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(_session("spark://host:7077"))


def test_checkpoint_dir_already_set_is_used():
    assert scratch_dir(_session("yarn", current="hdfs:///chk/app")) == "hdfs:///chk/app"
