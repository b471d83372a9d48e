"""Where scratch tables go."""

from types import SimpleNamespace

import pytest

from cadastro import session


def fake(master, conf=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf),
                           sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda d: None))


def test_a_cluster_session_must_name_its_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(fake("spark://host:7077"))
    with pytest.raises(RuntimeError):
        session.checkpoint_root(fake("local-cluster[2,1,1024]"))
    assert session.checkpoint_root(fake("yarn", "hdfs://shared/x/")) == "hdfs://shared/x"
    assert "cadastro-checkpoint-" in session.checkpoint_root(fake("local[4]"))
