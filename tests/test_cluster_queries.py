"""Queries that store derived tables, on a cluster whose scratch folder is a local path that all executors share."""

import pytest

from fixtures.queries import queries

NAMES = (
    "baseline_band_weekday", "baseline_rowcount", "baseline_rowcount_detail", "baseline_sigma",
    "classify_completeness", "classify_completeness_detail", "classify_plain", "classify_rate",
    "classify_rate_trend", "classify_sigma", "classify_trend", "completeness_look_back", "completeness_score",
    "completeness_start", "detail_anomaly", "detail_completeness", "detail_init", "detail_no_data",
    "history_anomaly", "history_completeness", "kpi_select", "kpi_semi_join",
)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Some lines of 21 suppliers a day, but those of supplier 9 on some days only."""
    folder = str(tmp_path_factory.mktemp("tables"))
    days = "explode(sequence(date'2001-03-01', date'2001-06-20')) as day"
    spark.sql(
        f"""select cast(day as timestamp) as l_shipdate, s.id as l_suppkey, 'A' as l_returnflag, 1 as l_linenumber,
                cast(pmod(hash(day, s.id), 50) + 1 as double) as l_quantity, 900.5D as l_extendedprice, 0.05D as l_discount
            from (select {days}) cross join range(21) s
            where s.id != 9 or day < date'2001-06-01' and day(day) % 9 = 0"""
    ).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    spark.range(21).selectExpr("id as s_suppkey").coalesce(1).write.parquet(f"{folder}/supplier.parquet")
    return folder


@pytest.mark.parametrize("name", NAMES)
def test_a_shared_local_folder_serves_on_a_cluster(spark, tables, monkeypatch, name):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://a:7077")
    assert not queries()[name](spark, tables).isEmpty()
