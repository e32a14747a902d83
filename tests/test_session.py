"""The shared scratch folder."""

from types import SimpleNamespace

import pytest

from acctlake.session import scratch_root


def fake(master, conf=None):
    got = {}
    return SimpleNamespace(
        sparkContext=SimpleNamespace(
            master=master, getConf=lambda: SimpleNamespace(get=lambda k: conf), getCheckpointDir=lambda: None,
            setCheckpointDir=lambda d: got.update(dir=d)),
        conf=SimpleNamespace(get=lambda k, d: d, set=lambda k, v: got.update(set=v)), got=got)


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_root(fake(master))
        assert scratch_root(fake(master, "hdfs://host/scratch/")) == "hdfs://host/scratch"


def test_one_machine_gets_a_local_one():
    session = fake("local[4]")
    assert scratch_root(session) == session.got["dir"] == session.got["set"]
