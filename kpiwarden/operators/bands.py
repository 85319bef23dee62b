"""Bands: mean and bounds of the recent accepted rows of each series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwarden.functions.rules import Rule
from kpiwarden.functions.sums import as_double, total_of_totals
from kpiwarden.operators.recent import SERIES


def bounds(
    rule: Rule, mean: Column, filled: Column, squares: Column, low: Column, high: Column
) -> tuple[Column, Column]:
    """Lower and upper bound.

    ``squares`` is the sum of squared deviations from the mean. A single value
    has no sample deviation and so no bounds under a sigma rule.
    """
    lower, upper = rule.band(mean)
    if rule.sigmas is None:
        return lower, upper
    deviation = F.sqrt(F.greatest(squares, F.lit(0.0)) / F.nullif(filled - 1, F.lit(0)))
    width = F.lit(rule.sigmas) * deviation
    flat = (filled > 1) & (low == high)
    return F.when(flat, lower).otherwise(mean - width), F.when(flat, upper).otherwise(mean + width)


def series_bands(days: DataFrame, rule: Rule) -> DataFrame:
    """Band per series from its ``recent_days``; key columns and bounds.

    Squared deviations are summed around the mean of the latest day, so that
    large values with a small spread keep their digits.
    """
    mean_of_day = F.try_divide(as_double(F.col("total")), "filled")
    latest_first = (
        Window.partitionBy(*SERIES)
        .orderBy(F.desc("date"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pivot = F.first(mean_of_day, ignorenulls=True).over(latest_first)
    off = F.col("off")
    per_series = (
        days.withColumn("off", mean_of_day - pivot)
        .groupBy(*SERIES)
        .agg(
            F.sum("filled").alias("filled"),
            F.try_divide(as_double(total_of_totals("total")), F.sum("filled")).alias("rata"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            (
                F.sum(F.col("spread") + F.col("filled") * off * off)
                - F.try_divide(F.pow(F.sum(F.col("filled") * off), 2), F.sum("filled"))
            ).alias("squares"),
        )
    )
    lower, upper = bounds(rule, *[F.col(c) for c in ("rata", "filled", "squares", "low", "high")])
    return per_series.select(
        "series.*", upper.alias("b_atas"), lower.alias("b_bawah"), F.col("rata")
    )
