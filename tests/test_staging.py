"""Where intermediate tables may be written."""

from types import SimpleNamespace

import pytest

from wakeline.sources.staging import shared_dir


def _session(master, named=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: named), sparkContext=context)


def test_a_cluster_without_shared_folder_is_refused():
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(_session(master))


def test_the_named_folder_is_used():
    assert shared_dir(_session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
