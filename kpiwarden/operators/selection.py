"""Which KPIs, sites and rows take part.

No join here carries a broadcast hint: Spark broadcasts a side it knows to be
below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise, and the
shuffled forms below are ones whose hot keys adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiwarden.functions.rules import Rule
from kpiwarden.sources.schema import REQUIRED_KEYS

SITE_NAME_LENGTH = 6


def kpi_select(kpi_list: DataFrame, category: str, rule: Rule) -> DataFrame:
    """KPIs of a category that are switched on and belong to the rule's class."""
    return kpi_list.where(
        (F.col("status") == "include")
        & (F.col("rate_status") == rule.rate_status)
        & (F.col("trend") == rule.trend)
        & (F.col("category") == category)
    ).select("kpi")


def kpi_classes(kpi_list: DataFrame, category: str) -> DataFrame:
    """Switched-on KPIs of a category with their class."""
    return (
        kpi_list.where((F.col("status") == "include") & (F.col("category") == category))
        .select("kpi", "rate_status", "trend")
        .distinct()
    )


def of_kpis(df: DataFrame, kpis: DataFrame) -> DataFrame:
    """Rows whose KPI is selected."""
    return df.join(kpis.select("kpi"), "kpi", "left_semi")


def of_series(df: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the series that ``wanted`` has rows of; a key value that is missing matches nothing."""
    return df.join(wanted.select(*by).distinct(), list(by), "left_semi")


def misnamed() -> Column:
    """Whether a row is of a site whose location does not have six characters."""
    return (F.col("level") == "site") & (F.length("location") != SITE_NAME_LENGTH)


def misnamed_sites(sites: DataFrame) -> DataFrame:
    """Site rows whose location does not have six characters."""
    return sites.where(misnamed()).select("level", "location")


def bad_site_locations(sites: DataFrame) -> DataFrame:
    """Each misnamed location once."""
    return misnamed_sites(sites).select("location").distinct()


def outside_bad_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Drop rows, of any level, whose location is the name of a misnamed site.

    Rows without a location stay. The names are made distinct together with the
    level, so that a shuffled join exchanges them once more by location alone:
    only then can adaptive execution split a location holding many rows.
    """
    names = misnamed_sites(sites).distinct().select("location")
    return df.join(names, "location", "left_anti")


def not_in_bad_sites(df: DataFrame, sites: DataFrame) -> DataFrame:
    """``location NOT IN (bad sites)``, nulls included.

    A row without a location stays only if there is no bad site at all. Written
    as an anti join plus a one-row test, since Spark's own NOT IN broadcasts the
    list whatever its size.
    """
    any_bad = misnamed_sites(sites).limit(1).exists()
    return outside_bad_sites(df, sites).where(F.col("location").isNotNull() | ~any_bad)


def with_complete_keys(df: DataFrame) -> DataFrame:
    """Rows that have every key but, perhaps, the vendor.

    One test per column, unlike ``dropna``, so that each reaches the scan.
    """
    for key in REQUIRED_KEYS:
        df = df.where(F.col(key).isNotNull())
    return df


def eligible(df: DataFrame, kpis: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows an anomaly rule looks at."""
    return outside_bad_sites(of_kpis(with_complete_keys(df), kpis), sites)
