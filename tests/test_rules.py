"""Each arm of each rule on single rows: band 90..110 of a mean of 100."""

import pytest
from pyspark.sql import functions as F

from kpiwarden.functions import rules

CASES = {
    # rule: statuses of null, -1, 0, 90, 110, 89.99, 110.01, and of 120 with band 90..130
    "PLAIN": ["anomaly", "anomaly", "anomaly", "ok", "ok", "anomaly", "anomaly", "ok"],
    "TREND": ["anomaly", "anomaly", "anomaly", "ok", "ok", "anomaly", "anomaly", "ok"],
    "RATE": ["anomaly", "anomaly", "anomaly", "ok", "anomaly", "anomaly", "anomaly", "anomaly"],
    "RATE_TREND": ["anomaly", "anomaly", "anomaly", "ok", "anomaly", "anomaly", "anomaly", "anomaly"],
    "SIGMA": ["anomaly", "anomaly", "anomaly", "ok", "ok", "anomaly", "anomaly", "ok"],
    "COMPLETENESS": ["not ok", "not ok", "not ok", "ok", "ok", "not ok", "duplicated", "ok"],
    "COMPLETENESS_DETAIL": ["not ok", "not ok", "not ok", "ok", "ok", "not ok", "duplicated", "ok"],
}
INPUTS = [
    (None, 90.0, 110.0), (-1.0, 90.0, 110.0), (0.0, 90.0, 110.0), (90.0, 90.0, 110.0),
    (110.0, 90.0, 110.0), (89.99, 90.0, 110.0), (110.01, 90.0, 110.0), (120.0, 90.0, 130.0),
]


def statuses(spark, rule, inputs):
    df = spark.createDataFrame(
        [(i, *row) for i, row in enumerate(inputs)], "i int, v double, lo double, hi double"
    )
    status = rule.status(F.col("v"), F.col("lo"), F.col("hi"))
    return [r["s"] for r in df.select("i", status.alias("s")).orderBy("i").collect()]


@pytest.mark.parametrize("name", CASES)
def test_arms(spark, name):
    assert statuses(spark, getattr(rules, name), INPUTS) == CASES[name]


def test_zero_and_negative_within_the_band(spark):
    inputs = [(0.0, -5.0, 5.0), (-1.0, -5.0, 5.0)]
    expected = {
        "PLAIN": ["anomaly", "anomaly"],
        "TREND": ["ok", "anomaly"],
        "RATE": ["ok", "anomaly"],
        "SIGMA": ["anomaly", "ok"],
        "COMPLETENESS": ["ok", "ok"],
    }
    for name, want in expected.items():
        assert statuses(spark, getattr(rules, name), inputs) == want, name


@pytest.mark.parametrize("name", CASES)
def test_without_band_nothing_is_ok(spark, name):
    rule = getattr(rules, name)
    assert statuses(spark, rule, [(50.0, None, None)]) == [rule.otherwise]


def test_seedable(spark):
    df = spark.createDataFrame([(v,) for v in (None, -1.0, 0.0, 100.0, 101.0)], "v double")
    kept = {
        r.name: [x["v"] for x in df.where(r.seedable(F.col("v"))).collect()]
        for r in rules.CLASS_RULES
    }
    assert kept["plain"] == kept["trend"] == [100.0, 101.0]
    assert kept["rate"] == kept["rate_trend"] == [0.0, 100.0]
