"""Sums of doubles are the same in any order and partitioning."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from kpiwarden.functions.rules import PLAIN
from kpiwarden.functions.sums import as_double, total_of, total_of_totals
from kpiwarden.plans.score import score


def sum_of(df):
    return df.agg(as_double(total_of(F.col("v"))).alias("t")).first()["t"]


def test_sums_are_exact(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-6, 16) for _ in range(3000)] + [1e15, -1e15, 0.1, -0.1, 2.0**61, -(2.0**61)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    want = float(sum(map(Fraction, values)))
    assert sum_of(df) == pytest.approx(want, rel=1e-15, abs=1e-12)
    assert len({sum_of(df.repartition(n).orderBy(F.rand(n))) for n in (1, 7, 40)}) == 1


def test_odd_values(spark):
    def of(*values):
        return sum_of(spark.createDataFrame([(v,) for v in values], "v double"))

    assert of(None, None) is None
    assert of(1.5, None, -0.25) == 1.25
    assert of(1e300, 1.0) == 1e300
    assert math.isnan(of(1.0, float("nan"))) and of(1.0, float("inf")) == float("inf")


def test_totals_of_totals(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), (F.col("id") * 0.1 - 30).alias("v"))
    days = df.groupBy("g").agg(total_of(F.col("v")).alias("total"))
    assert days.agg(as_double(total_of_totals("total")).alias("t")).first()["t"] == sum_of(df)


def test_a_value_on_a_bound_has_one_status(make):
    """Seven rows of a day whose sum as doubles depends on their order; the bound is met exactly."""
    key = make.key("S00001")
    values = [0.1, 0.2, 0.3, 1e9, 0.7, 1 / 3, 2 / 3]
    mean = float(sum(map(Fraction, values))) / 7
    found = set()
    for n in (1, 7, 200):
        results = make.results([("2024-01-01", key, v, "ok") for v in values]).repartition(n).orderBy(F.rand(n))
        rows = make.observations([("2024-01-02", key, mean * 0.9), ("2024-01-02", key, math.nextafter(mean * 0.9, 0))])
        out = score(rows, results, make.kpi_list(PLAIN), make.sites(), category="ran", rule=PLAIN, day="2024-01-02")
        found.add(tuple(sorted((r["value"], r["b_bawah"], r["status"]) for r in out.collect())))
    assert len(found) == 1
    assert [s for _, _, s in found.pop()] == ["anomaly", "ok"]
