from types import SimpleNamespace

import pytest

from changeflow import scratch


def session(folder, master):
    conf = SimpleNamespace(get=lambda name, default: folder if name == "spark.checkpoint.dir" else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app"))


def test_the_folder_of_the_session_is_used():
    assert scratch.shared_dir(session("hdfs://x/cp/", "yarn")) == "hdfs://x/cp"
    assert scratch.shared_path(session("/cp", "yarn"), "t").startswith("/cp/changeflow/t-")


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError):
        scratch.shared_dir(session(None, "yarn"))


def test_local_mode_falls_back_to_one_fresh_folder():
    first = scratch.shared_dir(session(None, "local[2]"))
    assert first == scratch.shared_dir(session(None, "local[2]")) and "changeflow-" in first


def test_sizes(spark, shared):
    spark.range(1000).write.parquet(shared)
    df = spark.read.parquet(shared)
    assert scratch.small(df) and not scratch.small(df, 10)
    assert scratch.exists(spark, shared) and not scratch.exists(spark, shared + "x")
    scratch.remove(spark, shared)
    assert not scratch.exists(spark, shared) and scratch.children(spark, shared) == []


def test_clear_removes_what_the_session_wrote(spark):
    path = scratch.shared_path(spark, "clear")
    spark.range(3).write.parquet(path)
    assert scratch.exists(spark, path)
    kept = dict(scratch._made)
    scratch._made[spark.sparkContext.applicationId] = [path]
    assert scratch.clear(spark) == 1 and not scratch.exists(spark, path)
    scratch._made.update(kept)
