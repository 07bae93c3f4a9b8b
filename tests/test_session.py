"""Where shared tables go."""

from types import SimpleNamespace

import pytest

from curbflow import session


def fake(master, named=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: named or default),
        sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"),
    )


def test_named_folder_wins():
    assert session.shared_root(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared/curbflow-app-yarn"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(fake("yarn"))


def test_local_sessions_keep_one_folder():
    spark = fake("local[2]")
    assert session.shared_root(spark) == session.shared_root(spark)
