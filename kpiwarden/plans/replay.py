"""Score a range of days, each day's accepted rows feeding the next.

Which rows of a day are accepted depends on the accepted rows of earlier days only. So
all days are judged at once, by bands from a first guess of what is accepted, and again
by bands from what that accepted, and so on. Each series has a frontier: the first day
whose accepted rows a round has changed. Up to and with it the round was right, as what
came before did not change; beyond it the days are judged again. A day is settled once
and then only counts as history, and a series without changes is done. So a round looks
at fewer series and days than the one before, and settles a day at least of each series.

Whether a day changed is told by the number of its accepted rows and two sums of their
hashes. A round is grouped sums, a join, and windows over one row per series and date. It
never gathers a series, however many rows it has, and it is the same for all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from kpiwarden.functions.dates import as_date, with_day_name
from kpiwarden.functions.rules import OK, Rule
from kpiwarden.functions.sums import as_double, total_of, total_of_totals
from kpiwarden.operators.judge import attach_band, judged, status_of
from kpiwarden.operators.recent import SERIES, means_before, recent_totals, with_series_hash
from kpiwarden.operators.selection import eligible, kpi_select, of_kpis, of_series
from kpiwarden.plans.score import accepted_before
from kpiwarden.sources.schema import KEYS
from kpiwarden.sources.scratch import stored

_DAY = ("rows", "filled", "total")
_MARK = ("rows", "low_hashes", "high_hashes")


def _inputs(observations, results, kpi_list, sites, category, rule, start, end, look_back):
    """Rows to score, their recent accepted totals before the range, and the series columns."""
    kpis = kpi_select(kpi_list, category, rule)
    within = F.col("date").between(as_date(start), as_date(end))
    rows = eligible(observations.where(within), kpis, sites)
    history = of_kpis(accepted_before(results, start), kpis)
    by = list(KEYS)
    if rule.by_weekday:
        rows, history = with_day_name(rows), with_day_name(history)
        by.append("day_name")
    rows = stored(rows.select("date", *by, rule.value), "replay-rows")
    prior = recent_totals(
        of_series(history, rows, by), rule.value, rule.depth, by,
        wanted=rows, before=start, look_back=look_back,
    )
    return rows, stored(prior.select(*SERIES, "date", *_DAY), "replay-prior"), by


def replay(
    observations: DataFrame,
    results: DataFrame,
    kpi_list: DataFrame,
    sites: DataFrame,
    *,
    category: str,
    rule: Rule,
    start: str,
    end: str,
    look_back: int | None = None,
) -> DataFrame:
    """Result rows of all days from start to end, both included.

    Results dated within the range are ignored; they are what gets replaced. The rounds
    run when this is called, and there are no more than the range has days.
    """
    rows, prior, by = _inputs(
        observations, results, kpi_list, sites, category, rule, start, end, look_back
    )
    rounds = list(_rounds(rows, prior, by, rule))
    settled = rounds[0].where("settled")
    for days in rounds[1:]:
        settled = settled.unionByName(days.where("settled"))
    return judged(_banded(rows, settled, [*by, "date"], by, rule), rule)


def _rounds(rows: DataFrame, prior: DataFrame, by: Sequence[str], rule: Rule) -> Iterator[DataFrame]:
    """The days that each round judged: the mean before them, what it accepted, and whether that is settled.

    Series without accepted rows before the range never have a band and are in no round.
    """
    mean = F.try_divide(as_double(total_of_totals("total")), F.sum("filled")).alias("rata")
    first = with_series_hash(prior.groupBy("series").agg(mean))
    days = _accepted(_banded(rows, first, by, by, rule, "inner", *SERIES), rule)
    history = [prior.select(*SERIES, "date", *_DAY)]
    known = history[0]
    while True:
        left = Observation()
        days = _judged_again(rows, known, days, by, rule).observe(
            left, F.min(F.when(~F.col("settled"), F.col("date"))).alias("since")
        )
        days = stored(days, "replay-days")
        yield days
        since = left.get["since"]
        if since is None:
            return
        history.append(days.where("settled and rows > 0").select(*SERIES, "date", *_DAY))
        days, rows = days.where("not settled"), rows.where(F.col("date") >= as_date(since))
        known = reduce(DataFrame.unionByName, history).join(days.select(*SERIES), list(SERIES), "left_semi")


def _judged_again(rows: DataFrame, known: DataFrame, days: DataFrame, by: Sequence[str], rule: Rule) -> DataFrame:
    """``days`` judged by bands from what is known and what they themselves accepted before.

    A day is settled if no earlier one of its series has changed.
    """
    days = days.select(*SERIES, "date", *_DAY, *_MARK[1:], F.lit(True).alias("asked"))
    days = days.unionByName(known.withColumn("asked", F.lit(False)), allowMissingColumns=True)
    # all steps keep a series together, so that what is dealt out once need not be again
    was = [f"was_{m}" for m in _MARK]
    means = means_before(days, rule.depth).withColumnsRenamed(dict(zip(_MARK, was)))
    banded = _banded(rows, means, [*by, "date"], by, rule, "inner", *SERIES, *was)
    again = _accepted(banded, rule, *[F.max(c).alias(c) for c in ("rata", *was)])
    changed = F.lit(False)
    for m, w in zip(_MARK, was):
        changed = changed | (F.col(m) != F.col(w))
    frontier = F.min(F.when(changed, F.col("date"))).over(Window.partitionBy(*SERIES))
    settled = F.coalesce(F.col("date") <= frontier, F.lit(True))
    return again.withColumn("settled", settled).select(*SERIES, "date", *_DAY, *_MARK[1:], "rata", "settled")


def _accepted(banded: DataFrame, rule: Rule, *more: Column) -> DataFrame:
    """Totals and marks of the accepted rows of each series and date; zero or null where none is."""
    ok = status_of(rule) == OK
    value = F.when(ok, F.col(rule.value).cast("double"))
    mark = F.when(ok, F.xxhash64(rule.value))
    return banded.groupBy(*SERIES, "date").agg(
        F.count_if(ok).alias("rows"),
        F.count(value).alias("filled"),
        total_of(value).alias("total"),
        F.coalesce(F.sum(mark.bitwiseAND(0xFFFFFFFF)), F.lit(0)).alias("low_hashes"),
        F.coalesce(F.sum(F.shiftright(mark, 32)), F.lit(0)).alias("high_hashes"),
        *more,
    )


def _banded(
    rows: DataFrame, means: DataFrame, on: Sequence[str], by: Sequence[str], rule: Rule,
    how: str = "left", *more: str,
) -> DataFrame:
    """Rows with the bounds around the mean of their series, or of their series and date."""
    lower, upper = rule.band(F.col("rata"))
    named = [F.col(f"series.{k}").alias(k) for k in by] + ["date"] * ("date" in on)
    return attach_band(rows, means.select(*named, upper.alias("b_atas"), lower.alias("b_bawah"), "rata", *more), on, how)
