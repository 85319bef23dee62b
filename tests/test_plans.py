"""Properties of the physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from kpiwarden.functions.rules import PLAIN
from kpiwarden.operators.bands import series_bands
from kpiwarden.operators.judge import attach_band
from kpiwarden.operators.recent import daily_totals, recent_days, recent_rows
from kpiwarden.operators.selection import (
    kpi_classes,
    kpi_select,
    not_in_bad_sites,
    of_kpis,
)
from kpiwarden.plans.detail import detail
from kpiwarden.plans.score import score
from kpiwarden.sources import schema
from kpiwarden.sources.store import DatedTable

SF_DIR = "/root/testdata/sf0.001"
SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    old = {}

    def set_all(values):
        for k, v in values.items():
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield set_all
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def stored(make, spark, tmp_path):
    """Observations and results stored by date."""
    key = make.key("S00001")
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    observations = DatedTable(spark, str(tmp_path / "o"), schema.OBSERVATIONS)
    observations.append(make.observations([(d, key, 100.0) for d in days]))
    results = DatedTable(spark, str(tmp_path / "r"), schema.ANOMALY_RESULTS)
    results.append(make.results([(d, key, 100.0, "ok") for d in days]))
    return observations.read(), results.read()


@pytest.mark.parametrize(
    "name", ["score_all", "completeness_score", "detail_anomaly", "seed_trend", "replay_plain"]
)
def test_no_python_and_no_cross_product(spark, name):
    text = plan(entry_module.queries()[name](spark, SF_DIR))
    for node in ("Python", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_nothing_is_broadcast_against_the_threshold(spark, conf):
    conf(SHUFFLED)
    for name in ("score_all", "completeness_score", "detail_anomaly", "seed_plain", "site_not_in"):
        text = plan(entry_module.queries()[name](spark, SF_DIR))
        assert not re.search("Broadcast(Exchange|HashJoin|NestedLoopJoin)", text), name


def test_rows_are_summed_before_any_shuffle(make):
    totals = recent_days(daily_totals(make.observations([]), "value"), 7)
    text = plan(series_bands(totals, PLAIN))
    first = text.rindex("Exchange hashpartitioning")
    assert "partial_count" in text[first:]
    # The series reaches a single task only as one total per date.
    assert text.index("Window") < text.rindex("HashAggregate")
    assert "spread" not in text and "partial_var_pop" not in text


def test_old_dates_are_dropped_before_the_second_shuffle(make):
    text = plan(recent_days(daily_totals(make.observations([]), "value"), 7))
    limits = [m.start() for m in re.finditer("WindowGroupLimit", text)]
    shuffles = [m.start() for m in re.finditer("Exchange hashpartitioning", text)]
    assert len(shuffles) == 2 and limits and shuffles[0] < limits[-1] < shuffles[1]


@pytest.mark.parametrize("name", ["score_all_look_back", "completeness_look_back", "seed_look_back"])
def test_registered_queries_prune_partitions(spark, conf, name):
    conf({"spark.sql.maxMetadataStringLength": "4000"})
    text = plan(entry_module.queries()[name](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ (IN|=|<|>)|PartitionFilters: \[[^\]]*(IN|isnotnull)\(?.*?date", text)


def test_dates_prune_partitions(make, stored, conf):
    conf({"spark.sql.maxMetadataStringLength": "2000"})
    observations, results = stored
    scored = score(
        observations, results, make.kpi_list(PLAIN), make.sites(),
        category="ran", rule=PLAIN, day="2024-01-05",
    )
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", plan(scored))
    assert any("= 2024-01-05" in f for f, _ in filters)
    assert any("< 2024-01-05" in f and "EqualTo(status,ok)" in pushed for f, pushed in filters)
    assert [r["status"] for r in scored.collect()] == ["ok"]


def test_weekday_prunes_partitions(make, stored, conf):
    from kpiwarden.functions.rules import TREND

    conf({"spark.sql.maxMetadataStringLength": "2000"})
    observations, results = stored
    scored = score(
        observations, results, make.kpi_list(TREND), make.sites(),
        category="ran", rule=TREND, day="2024-01-09",
    )
    assert re.search(r"PartitionFilters: \[.*?date_format\(.*?\]", plan(scored))


def test_look_back_leaves_old_dates_unread(make, stored, conf):
    conf({"spark.sql.maxMetadataStringLength": "2000"})
    observations, results = stored

    def scored(days):
        return score(
            observations, results, make.kpi_list(PLAIN), make.sites(),
            category="ran", rule=PLAIN, day="2024-01-09", look_back=days,
        )

    assert "< 2024-01-02" not in plan(scored(7))
    assert "< 2024-01-03" in plan(scored(6))
    assert scored(7).collect() == scored(6).collect() == scored(None).collect()


SKEW = {
    **SHUFFLED,
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def hot_rows(spark, make, n=60_000):
    """Rows of one day, nearly all of one series."""
    location = F.when(F.col("id") % 50 == 0, F.concat(F.lit("S"), F.lpad(F.col("id") % 9999, 5, "0")))
    return spark.range(0, n, 1, 8).select(
        F.lit("2024-01-02").cast("date").alias("date"),
        *[F.lit(v).alias(k) for k, v in zip(schema.KEYS[:5], make.key("x")[:5])],
        F.coalesce(location, F.lit("ALL")).alias("location"),
        (F.col("id") % 7 + 95.0 + F.rand(1) * 1e-6).alias("value"),
    )


def test_hot_series_is_split_in_the_band_join(spark, make, conf):
    conf(SKEW)
    history = make.results([("2024-01-01", make.key("ALL"), 100.0, "ok")])
    bands = series_bands(recent_days(daily_totals(history, "value"), 7), PLAIN)
    joined = attach_band(hot_rows(spark, make), bands)
    joined.collect()
    assert "skew=true" in plan(joined)


def test_hot_location_is_split_in_the_site_join(spark, make, conf):
    conf(SKEW)
    sites = make.sites([("site", f"S{i:06d}") for i in range(50)])
    kept = not_in_bad_sites(hot_rows(spark, make), sites)
    kept.collect()
    assert "skew=true" in plan(kept)


def test_hot_date_is_split_when_ranked_rows_are_joined_back(spark, make, conf):
    conf(SKEW)
    rows = recent_rows(hot_rows(spark, make), "value", 10)
    assert len(rows.collect()) > 50_000
    assert "skew=true" in plan(rows)


def test_hot_request_is_split_in_detail(spark, make, conf):
    conf(SKEW)
    history = make.results([(f"2023-12-{d:02d}", make.key("ALL"), 100.0, "ok") for d in range(1, 9)])
    asked = make.requests([("2024-01-02", make.key("ALL")), ("2024-01-02", make.key("GONE"))])
    checked = detail(hot_rows(spark, make), history, asked)
    assert len(checked.collect()) > 50_000
    assert "skew=true" in plan(checked)


@pytest.mark.parametrize("select", ["of_kpis", "kpi_classes"])
def test_hot_kpi_is_split(spark, make, conf, select):
    conf(SKEW)
    other = F.concat(F.lit("k"), (F.col("value") % 40).cast("int").cast("string"))
    rows = hot_rows(spark, make).withColumn(
        "kpi", F.when(F.col("location") == "ALL", "k").otherwise(other)
    )
    kpi_list = make.kpi_list(PLAIN, ["k", *[f"k{i}" for i in range(20)]])
    if select == "of_kpis":
        kept = of_kpis(rows, kpi_select(kpi_list, "ran", PLAIN))
    else:
        kept = rows.join(kpi_classes(kpi_list, "ran"), "kpi")
    kept.collect()
    assert "skew=true" in plan(kept)
