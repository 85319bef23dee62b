"""What result and history tables hold after a run, as plain DataFrames.

``kpiwarden.sources.store`` applies the same changes to stored tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.functions.dates import as_date, oldest_kept
from kpiwarden.functions.rules import KEEP_DAYS
from kpiwarden.sources.schema import KEYS

_BY = ["date", *KEYS]


def without_kpis(table: DataFrame, kpis: DataFrame) -> DataFrame:
    """Rows of other KPIs; rows without a KPI stay."""
    return table.join(kpis.select("kpi"), "kpi", "left_anti").select(*table.columns)


def replace_slice(table: DataFrame, fresh: DataFrame, kpis: DataFrame, day: str) -> DataFrame:
    """Replace the rows of some KPIs on one date, as a rerun of a scored day does."""
    on_day = F.col("date") == as_date(day)
    other_days = table.where(~on_day | F.col("date").isNull())
    return _added(other_days.unionByName(without_kpis(table.where(on_day), kpis)), fresh)


def reseed_class(table: DataFrame, fresh: DataFrame, kpis: DataFrame) -> DataFrame:
    """Replace all rows of some KPIs."""
    return _added(without_kpis(table, kpis), fresh)


def replace_date(table: DataFrame, fresh: DataFrame, day: str) -> DataFrame:
    """Replace all rows of one date."""
    on_day = F.col("date") == as_date(day)
    return _added(table.where(~on_day | F.col("date").isNull()), fresh)


def replace_series(table: DataFrame, fresh: DataFrame, requests: DataFrame) -> DataFrame:
    """Replace the rows of the requested dates and series.

    A request lacking a key value removes nothing. The requested dates are looked up first:
    rows of other dates stay as they are and are not shuffled.
    """
    asked = requests.select(*_BY).distinct()
    dates = [r["date"] for r in asked.select("date").distinct().where("date is not null").collect()]
    if not dates:
        return _added(table, fresh)
    concerned = F.col("date").isin(dates)
    other_dates = table.where(~concerned | F.col("date").isNull())
    kept = table.where(concerned).join(asked, _BY, "left_anti").select(*table.columns)
    return _added(other_dates.unionByName(kept), fresh)


def retain(history: DataFrame, as_of: str, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Drop rows dated ``keep_days`` or more before ``as_of``."""
    return history.where((F.col("date") > oldest_kept(as_of, keep_days)) | F.col("date").isNull())


def _added(kept: DataFrame, fresh: DataFrame) -> DataFrame:
    """Seeds and accepted first rows have no bounds; those become null."""
    return kept.unionByName(fresh, allowMissingColumns=True)
