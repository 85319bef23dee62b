"""Compare rows with the band of their series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwarden.functions.rules import Rule
from kpiwarden.sources.schema import BOUNDS, KEYS


def attach_band(
    rows: DataFrame, bands: DataFrame, by: Sequence[str] = KEYS, how: str = "left"
) -> DataFrame:
    """Join on plain equality: a row lacking a key value finds no band.

    Bands come from a grouping on the series struct, so a shuffled join exchanges
    them by the single columns. They are one row per series by then, and with a
    shuffle on either side adaptive execution can turn this into a broadcast join
    or split a series that has very many rows.
    """
    return rows.join(bands, list(by), how)


def status_of(rule: Rule) -> Column:
    """Status of a row that carries its value and bounds."""
    return rule.status(F.col(rule.value), F.col("b_bawah"), F.col("b_atas"))


def judged(rows: DataFrame, rule: Rule, *extra: str) -> DataFrame:
    """Result columns, with the status, of rows that carry their bounds."""
    return rows.select("date", *KEYS, rule.value, *BOUNDS, status_of(rule).alias("status"), *extra)
