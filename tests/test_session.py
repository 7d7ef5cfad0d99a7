from types import SimpleNamespace

import pytest

from apexlake.session import shared_folder


def session(conf=None, context=None, master="local[2]"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf if key == "spark.checkpoint.dir" else default),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: context, master=master, applicationId="app-1"),
    )


def test_the_folder_the_cluster_names_is_used():
    assert shared_folder(session("hdfs://x/checkpoints/", master="spark://m")) == "hdfs://x/checkpoints"
    assert shared_folder(session(context="hdfs://x/own", master="yarn")) == "hdfs://x/own"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(session(master="yarn"))


def test_local_mode_falls_back_to_one_temporary_folder():
    assert shared_folder(session()) == shared_folder(session())


def test_a_real_session_has_a_folder(spark):
    assert shared_folder(spark)
