from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from kpiwarden.sources import schema  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("kpiwarden-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Make:
    """Small tables; a series is given by its location, the other keys are fixed."""

    def __init__(self, spark):
        self.spark = spark

    @staticmethod
    def key(location, kpi="k", vendor="V", level="site", node="n"):
        return (kpi, "daily", node, vendor, level, location)

    def observations(self, rows):
        """rows: (day, key, value)"""
        data = [(date.fromisoformat(d), *k, v) for d, k, v in rows]
        return self.spark.createDataFrame(data, schema.OBSERVATIONS)

    def row_counts(self, rows):
        data = [(date.fromisoformat(d), *k, v) for d, k, v in rows]
        return self.spark.createDataFrame(data, schema.ROW_COUNTS)

    def results(self, rows, count=False):
        """rows: (day, key, value, status)"""
        data = [(date.fromisoformat(d), *k, v, None, None, None, s) for d, k, v, s in rows]
        to = schema.COMPLETENESS_RESULTS if count else schema.ANOMALY_RESULTS
        return self.spark.createDataFrame(data, to)

    def requests(self, rows):
        data = [(date.fromisoformat(d), *k) for d, k in rows]
        return self.spark.createDataFrame(data, schema.REQUESTS)

    def sites(self, rows=()):
        return self.spark.createDataFrame(list(rows), schema.SITES)

    def kpi_list(self, rule, kpis=("k",), category="ran"):
        data = [(k, "include", rule.rate_status, rule.trend, category) for k in kpis]
        return self.spark.createDataFrame(data, schema.KPI_LIST)


@pytest.fixture(scope="session")
def make(spark):
    return Make(spark)
