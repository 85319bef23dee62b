"""Judge one day's rows against the recent accepted results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.functions.dates import as_date, on_weekday_of, with_day_name
from kpiwarden.functions.rules import CLASS_RULES, COMPLETENESS, OK, Rule
from kpiwarden.operators.bands import series_bands
from kpiwarden.operators.judge import attach_band, judged, status_of
from kpiwarden.operators.recent import recent_days, recent_totals
from kpiwarden.operators.selection import (
    eligible,
    kpi_classes,
    kpi_select,
    not_in_bad_sites,
    of_kpis,
    of_series,
    outside_bad_sites,
    with_complete_keys,
)
from kpiwarden.sources.schema import BOUNDS, KEYS


def accepted_before(results: DataFrame, day: str) -> DataFrame:
    return results.where((F.col("status") == OK) & (F.col("date") < as_date(day)))


def _known_before(results: DataFrame | None, recent: DataFrame | None, day: str) -> DataFrame:
    """Accepted rows before a day or, where ``recent`` is given, their daily totals."""
    return accepted_before(results, day) if recent is None else recent.where(F.col("date") < as_date(day))


def _ranked(
    history: DataFrame, today: DataFrame, rule: Rule, by: Sequence[str], day: str,
    look_back: int | None, totals: bool,
) -> DataFrame:
    """The recent days of today's series, from rows or from daily totals."""
    history = of_series(history, today, by)
    if totals:
        return recent_days(history.withColumn("series", F.struct(*by)), rule.depth)
    return recent_totals(history, rule.value, rule.depth, by, wanted=today, before=day, look_back=look_back)


def score(
    observations: DataFrame,
    results: DataFrame | None,
    kpi_list: DataFrame,
    sites: DataFrame,
    *,
    category: str,
    rule: Rule,
    day: str,
    look_back: int | None = None,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Result rows of one day for one KPI class.

    Of the history only series with a row today are looked at. That also clears it of
    bad sites and incomplete keys, as the keys are part of the series.

    ``recent``, from ``RecentDays.before``, takes the place of ``results``, which are not
    read then and may be None; the rows are the same.
    """
    kpis = kpi_select(kpi_list, category, rule)
    today = eligible(observations.where(F.col("date") == as_date(day)), kpis, sites)
    history = of_kpis(_known_before(results, recent, day), kpis)
    if rule.by_weekday:
        today = with_day_name(today)
        history = history.where(on_weekday_of(day))
    days = _ranked(history, today, rule, KEYS, day, look_back, recent is not None)
    rows = attach_band(today, series_bands(days, rule))
    return judged(rows, rule, *(["day_name"] if rule.by_weekday else []))


def score_all(
    observations: DataFrame,
    results: DataFrame | None,
    kpi_list: DataFrame,
    sites: DataFrame,
    *,
    category: str,
    day: str,
    look_back: int | None = None,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Result rows of one day for all four classes, reading each table once; ``recent`` as for ``score``."""
    classes = kpi_classes(kpi_list, category)
    by = ("rate_status", "trend", *KEYS)
    today = observations.where(F.col("date") == as_date(day))
    today = outside_bad_sites(with_complete_keys(today).join(classes, "kpi"), sites)
    history = (
        _known_before(results, recent, day)
        .join(classes, "kpi")
        .where((F.col("trend") == "F") | on_weekday_of(day))
    )
    # The four classes share depth and factors; only their rejected values differ.
    shared = CLASS_RULES[0]
    days = _ranked(history, today, shared, by, day, look_back, recent is not None)
    rows = attach_band(today, series_bands(days, shared), by)
    status = reduce(
        lambda earlier, rule: earlier.when(
            (F.col("rate_status") == rule.rate_status) & (F.col("trend") == rule.trend),
            status_of(rule),
        ),
        CLASS_RULES,
        F,
    )
    return rows.select(
        "date", *KEYS, "value", *BOUNDS, status.alias("status"), "rate_status", "trend"
    )


def score_completeness(
    row_counts: DataFrame,
    results: DataFrame | None,
    sites: DataFrame | None = None,
    *,
    day: str,
    rule: Rule = COMPLETENESS,
    look_back: int | None = None,
    recent: DataFrame | None = None,
) -> DataFrame:
    """Completeness of one day's row counts.

    There is no KPI list and keys may be missing. Misnamed sites are looked up in
    ``row_counts`` itself unless ``sites`` is given, as by ``MisnamedSites.read``;
    ``recent`` as for ``score``.
    """
    today = row_counts.where(F.col("date") == as_date(day))
    today = not_in_bad_sites(today, row_counts if sites is None else sites)
    history = _known_before(results, recent, day)
    days = _ranked(history, today, rule, KEYS, day, look_back, recent is not None)
    return judged(attach_band(today, series_bands(days, rule)), rule)


def alerts(results: DataFrame, rule: Rule) -> DataFrame:
    """The rows that go to the history table."""
    return results.where(F.col("status") == rule.alert)
