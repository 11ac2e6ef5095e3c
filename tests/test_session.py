"""Where work files go."""

from types import SimpleNamespace

import pytest

from ratelake.session import materialize, settings, shared_folder


def fake(master, configured=None):
    state = {"dir": None}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: state["dir"],
        setCheckpointDir=lambda d: state.update(dir=d),
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: configured), sparkContext=context)


def test_the_configured_folder_is_used():
    assert shared_folder(fake("yarn", "hdfs:///work/")) == "hdfs:///work"


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(fake("yarn"))


def test_a_local_session_makes_its_own_once():
    session = fake("local[2]")
    assert shared_folder(session) == shared_folder(session)


def test_settings_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(RuntimeError), settings(spark, {name: "3"}):
        assert spark.conf.get(name) == "3"
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_a_written_copy_has_no_lineage_and_prunes_columns(spark):
    copy = materialize(spark.range(10).selectExpr("id", "id * 2 AS twice"))
    text = copy.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in text and "ReadSchema: struct<id:bigint>" in text
    assert copy.count() == 10
