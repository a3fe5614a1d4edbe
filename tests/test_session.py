"""Shared scratch space."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from landfall.session import RUNTIME_SETTINGS, materialize, scratch_folder, shared_root


def session(master, setting=None, directory=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: directory)
    conf = SimpleNamespace(get=lambda name, default: setting or default)
    return SimpleNamespace(sparkContext=context, conf=conf)


def test_clusters_need_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "k8s://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_root(session(master))
        assert shared_root(session(master, setting="s3://a/b/")) == "s3://a/b"
        assert shared_root(session(master, directory="hdfs://c")) == "hdfs://c"


def test_one_machine_may_use_its_own():
    assert shared_root(session("local[4]")) == shared_root(session("local"))


def test_stages_go_with_their_job(spark):
    with scratch_folder(spark, "job") as folder:
        assert materialize(spark, spark.range(3), "stage", folder).count() == 3
        place = Path(folder.removeprefix("file:"))
        assert place.exists()
    assert not place.exists()
    with pytest.raises(KeyError):
        with scratch_folder(spark, "job") as folder:
            materialize(spark, spark.range(3), "stage", folder)
            raise KeyError
    assert not Path(folder.removeprefix("file:")).exists()


def test_settings(spark):
    assert all(spark.conf.get(name) == value for name, value in RUNTIME_SETTINGS.items())
