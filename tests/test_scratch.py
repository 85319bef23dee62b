"""Where intermediate tables may go, and what becomes of their shuffles."""

import shutil
from types import SimpleNamespace

import pytest

from fixtures import derived
from kpiwarden.sources.scratch import CLEANUP, SHARED, exists, removed, scratch_path, stored


def session(master, default=None, **conf):
    hadoop = SimpleNamespace(get=lambda key: default)
    context = SimpleNamespace(master=master, _jsc=SimpleNamespace(hadoopConfiguration=lambda: hadoop))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: conf.get(key, other)), sparkContext=context)


@pytest.mark.parametrize("master", ["local", "local[4]"])
def test_a_local_session_needs_no_setting(master):
    assert "/rows-" in scratch_path(session(master), "rows")


@pytest.mark.parametrize("master", ["yarn", "spark://a:1", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_folder(master):
    with pytest.raises(ValueError, match="checkpoint.dir"):
        scratch_path(session(master), "rows")


def test_local_folders_of_a_cluster():
    there = {"spark.checkpoint.dir": "/data/scratch"}
    with pytest.raises(ValueError, match="local folder"):
        scratch_path(session("yarn", **there), "rows")
    assert scratch_path(session("yarn", "hdfs://name:8020", **there), "rows").startswith("/data/scratch/rows-")
    assert scratch_path(session("yarn", **there, **{SHARED: "true"}), "rows")
    with pytest.raises(ValueError, match="local folder"):
        scratch_path(session("yarn", "hdfs://name:8020", **{"spark.checkpoint.dir": "file:///tmp"}), "rows")
    assert scratch_path(session("local-cluster[2,1,1024]", **there), "rows")


def on_cluster(spark, **conf):
    """A session that is on a cluster by its master's name."""
    hidden = session("spark://a:1", **conf)
    hidden.sparkContext.applicationId = spark.sparkContext.applicationId
    hidden.sparkContext.defaultParallelism = 2
    for name in ("range", "read", "_jvm", "_jsparkSession"):
        setattr(hidden, name, getattr(spark, name))
    return hidden


def test_a_local_folder_that_all_tasks_see_is_taken(spark, tmp_path):
    common, blocked = tmp_path / "common", tmp_path / "file" / "below"
    blocked.parent.write_text("no folder")
    there = on_cluster(spark, **{"spark.checkpoint.dir": common.as_uri()})
    assert scratch_path(there, "rows").startswith(f"{common.as_uri()}/rows-")
    assert list(common.iterdir()) == []
    there.range = None  # tried once
    assert scratch_path(there, "rows")
    with pytest.raises(ValueError, match="local folder"):
        scratch_path(on_cluster(spark, **{"spark.checkpoint.dir": blocked.as_uri()}), "rows")


def test_rows_that_the_driver_misses_make_a_folder_unfit(spark, tmp_path):
    there = on_cluster(spark, **{"spark.checkpoint.dir": tmp_path.as_uri()})
    there.read = SimpleNamespace(parquet=lambda path: spark.read.parquet(path).limit(1))
    for _ in range(2):
        with pytest.raises(ValueError, match="local folder"):
            scratch_path(there, "rows")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_the_warehouse_serves_where_no_folder_is_set(master):
    there = {"spark.sql.warehouse.dir": "hdfs://name:8020/warehouse/"}
    assert scratch_path(session(master, **there), "rows").startswith("hdfs://name:8020/warehouse/kpiwarden-scratch/rows-")
    there["spark.checkpoint.dir"] = "hdfs://name:8020/scratch"
    assert scratch_path(session(master, **there), "rows").startswith("hdfs://name:8020/scratch/rows-")


def test_a_temporary_folder_is_local_whatever_the_default():
    assert scratch_path(session("local[4]", "hdfs://name:8020"), "rows").startswith("file:/")


def test_derived_tables_that_are_gone_are_derived_again(spark, tmp_path):
    spark.sql("select 'A' as l_returnflag").write.parquet(str(tmp_path / "lineitem.parquet"))
    first = derived.kpi_list(spark, str(tmp_path))
    assert first.count() == 6 and derived.kpi_list(spark, str(tmp_path)) is first
    path, _ = derived._stored[(spark.sparkContext.applicationId, str(tmp_path), "kpi-list")]
    shutil.rmtree(path)
    assert not exists(spark, path)
    assert derived.kpi_list(spark, str(tmp_path)).count() == 6


def test_stored_rows_leave_settings_as_they_were(spark):
    before = spark.conf.get(CLEANUP, None)
    rows = stored(spark.range(100).repartition(3, "id"), "rows")
    assert rows.count() == 100 and spark.conf.get(CLEANUP, None) == before
    removed(rows)
    assert not spark._jvm.java.io.File(rows._scratch_path).exists()
