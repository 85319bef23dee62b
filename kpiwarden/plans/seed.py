"""Fill the baseline of a KPI class from raw observations."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.functions.dates import as_date, with_day_name
from kpiwarden.functions.rules import OK, SEED_DEPTH, Rule
from kpiwarden.operators.recent import enough_rows, recent_rows
from kpiwarden.operators.selection import (
    kpi_select,
    of_kpis,
    outside_bad_sites,
    with_complete_keys,
)
from kpiwarden.sources.schema import KEYS


def seed(
    observations: DataFrame,
    kpi_list: DataFrame,
    sites: DataFrame,
    *,
    category: str,
    rule: Rule,
    up_to: str,
    depth: int = SEED_DEPTH,
    look_back: int | None = None,
) -> DataFrame:
    """The ``depth`` most recent usable rows per series, accepted as they are.

    Trend classes take that many per weekday. Rows carry no bounds. Bad sites are
    dropped last: the location is part of the series, so this leaves the ranks
    alone, and only the few rows kept can be shuffled for it. ``look_back`` changes
    no row; it keeps old rows of series that have enough recent ones out of the shuffle.
    """
    rows = observations.where(
        (F.col("date") <= as_date(up_to)) & rule.seedable(F.col(rule.value))
    )
    rows = of_kpis(with_complete_keys(rows), kpi_select(kpi_list, category, rule))
    by = KEYS
    if rule.by_weekday:
        rows, by = with_day_name(rows), (*KEYS, "day_name")
    if look_back is not None:
        day_after = Date.fromisoformat(up_to) + timedelta(days=1)
        rows = enough_rows(
            rows, depth, by, wanted=rows, before=day_after, look_back=look_back
        )
    recent = outside_bad_sites(recent_rows(rows, rule.value, depth, by), sites)
    return recent.select("date", *KEYS, rule.value, F.lit(OK).alias("status"))
