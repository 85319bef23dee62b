"""Date expressions."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def as_date(day: str | Date) -> Column:
    """A date literal from ``YYYY-MM-DD`` or a ``datetime.date``."""
    return F.lit(day if isinstance(day, Date) else Date.fromisoformat(day))


def weekday_name(day: Column | str) -> Column:
    """English weekday name, not padded."""
    return F.date_format(day, "EEEE")


def with_day_name(df: DataFrame) -> DataFrame:
    """Ensure an unpadded ``day_name``: trimmed if the table has one, else derived."""
    if "day_name" in df.columns:
        return df.withColumn("day_name", F.trim("day_name"))
    return df.withColumn("day_name", weekday_name("date"))


def on_weekday_of(day: str | Date) -> Column:
    """True for rows whose date falls on the same weekday as ``day``.

    Only refers to ``date``, so it prunes date partitions.
    """
    return weekday_name("date") == weekday_name(as_date(day))


def days_after(day: Column | str, days: int) -> Column:
    return F.date_add(day, days)


def each_day(start: Column, end: Column) -> Column:
    """Array of the days from start to end, both included; empty if end is earlier."""
    empty = F.array().cast("array<date>")
    return F.when(start <= end, F.sequence(start, end, F.expr("interval 1 day"))).otherwise(empty)


def replay_dates(spark: SparkSession, start: str | Date, end: str | Date) -> DataFrame:
    """One row per day of a replay."""
    one_row = spark.range(1)
    return one_row.select(F.explode(each_day(as_date(start), as_date(end))).alias("date"))


def oldest_kept(as_of: str | Date, keep_days: int) -> Column:
    """Retention cut-off: rows dated on or before it are dropped."""
    return F.date_sub(as_date(as_of), keep_days)
