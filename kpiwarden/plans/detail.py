"""Check single series in detail, many requests in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwarden.functions.rules import (
    COMPLETENESS_DETAIL,
    MIN_ACCEPTED,
    NO_DATA,
    OK,
    SIGMA,
    Rule,
)
from kpiwarden.functions.sums import as_double, total_of
from kpiwarden.operators.bands import bounds
from kpiwarden.operators.recent import SERIES, with_series_hash
from kpiwarden.operators.slices import in_slices
from kpiwarden.sources.schema import BOUNDS, KEYS

_BY = ["date", *KEYS]


def _request_days(
    source: DataFrame, results: DataFrame, requests: DataFrame, rule: Rule
) -> DataFrame:
    """Per series and date: totals of its accepted results, and what is asked for.

    Repeated result rows count once for the band (``rows`` and the totals) but
    each for the number of accepted rows (``copies``).
    """
    series = F.struct(*KEYS).alias("series")
    wanted = requests.select(*_BY).distinct()
    no = F.lit(False)
    asked = wanted.select(series, "date", F.lit(True).alias("asked"), no.alias("present"))
    present = (
        source.join(wanted, _BY, "left_semi")
        .select(series, "date", no.alias("asked"), F.lit(True).alias("present"))
    )
    accepted = (
        results.where(F.col("status") == OK)
        .join(requests.select(*KEYS), list(KEYS), "left_semi")
        .groupBy(series, "date", F.col(rule.value).cast("double").alias("v"), *BOUNDS)
        .agg(F.count(F.lit(1)).alias("n"))
        .select("series", "date", "v", "n", no.alias("asked"), no.alias("present"))
    )
    v = F.col("v")
    return (
        accepted.unionByName(asked, allowMissingColumns=True)
        .unionByName(present, allowMissingColumns=True)
        .groupBy("series", "date")
        .agg(
            F.count("n").alias("rows"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("copies"),
            F.count(v).alias("filled"),
            as_double(total_of(v)).alias("total"),
            F.min(v).alias("low"),
            F.max(v).alias("high"),
            (F.var_pop(v) * F.count(v)).alias("spread"),
            F.max("asked").alias("asked"),
            F.max("present").alias("present"),
        )
    )


def _sum_of(days: Column, amount) -> Column:
    return F.aggregate(days, F.lit(0.0), lambda acc, d: acc + amount(d))


def _on_requested_dates(source: DataFrame, requests: DataFrame) -> DataFrame:
    """Source rows of the requested dates; these are looked up first, so that the scan is pruned to them."""
    dates = [r["date"] for r in requests.select("date").distinct().where("date is not null").collect()]
    return source.where(F.col("date").isin(dates) if dates else F.lit(False))


def request_bands(
    source: DataFrame, results: DataFrame, requests: DataFrame, rule: Rule
) -> DataFrame:
    """One row per request: its band, ``jml`` and ``present``.

    ``jml`` counts the accepted rows of the series on all dates but the requested
    one, whose rows are about to be replaced; ``present`` tells whether the source
    has a row. The requested day sees the totals of its previous ``depth`` days
    with accepted rows, found by the position of each day within its series.
    Large results are looked at in slices of series.
    """
    return in_slices(
        results, KEYS, lambda of: _request_bands(of(source), of(results), of(requests), rule), "request-bands"
    )


def _request_bands(
    source: DataFrame, results: DataFrame, requests: DataFrame, rule: Rule
) -> DataFrame:
    by_date = Window.partitionBy(*SERIES).orderBy("date")
    earlier = by_date.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*SERIES)
    days = with_series_hash(_request_days(source, results, requests, rule))
    positions = days.withColumns(
        {
            "position": F.coalesce(F.count(F.when(F.col("rows") > 0, 1)).over(earlier), F.lit(0)),
            "rows_before": F.coalesce(F.sum("rows").over(earlier), F.lit(0)),
            "jml": F.sum("copies").over(whole) - F.col("copies"),
        }
    )
    day = F.struct("rows_before", "rows", "filled", "total", "low", "high", "spread")
    previous = (
        Window.partitionBy(*SERIES).orderBy("position").rangeBetween(-rule.depth, -1)
    )
    found = positions.withColumn(
        "days", F.collect_list(F.when(F.col("rows") > 0, day)).over(previous)
    ).where("asked")
    # Rows later than a day and before the request: fewer than depth, so it ranks.
    found = found.withColumn(
        "days",
        F.filter(
            "days",
            lambda d: F.col("rows_before") - d["rows_before"] - d["rows"] < rule.depth,
        ),
    )
    days = F.col("days")
    found = found.withColumns(
        {
            "band_filled": F.aggregate(
                days, F.lit(0).cast("bigint"), lambda acc, d: acc + d["filled"]
            ),
            "band_total": _sum_of(days, lambda d: F.coalesce(d["total"], F.lit(0.0))),
            "band_low": F.array_min(F.transform(days, lambda d: d["low"])),
            "band_high": F.array_max(F.transform(days, lambda d: d["high"])),
        }
    ).withColumn("rata", F.try_divide("band_total", "band_filled"))

    def squares(d: Column) -> Column:
        off = F.try_divide(d["total"], d["filled"]) - F.col("rata")
        return F.coalesce(d["spread"] + d["filled"] * off * off, F.lit(0.0))

    lower, upper = bounds(
        rule, F.col("rata"), F.col("band_filled"), _sum_of(days, squares),
        F.col("band_low"), F.col("band_high"),
    )
    return found.select(
        "date", "series.*",
        upper.alias("b_atas"), lower.alias("b_bawah"), "rata",
        "jml", "present", (F.size("days") > 0).alias("has_band"),
    )


def series_exists(source: DataFrame, requests: DataFrame) -> DataFrame:
    """Each request with ``hasil`` 1 if the source has a row for it, else 0."""
    wanted = requests.select(*_BY).distinct()
    there = _on_requested_dates(source.select(*_BY), requests).join(wanted, _BY, "left_semi")
    there = there.distinct().withColumn("hasil", F.lit(1))
    return (
        wanted.join(there, _BY, "left")
        .select(*_BY, F.coalesce("hasil", F.lit(0)).alias("hasil"))
    )


def detail(
    source: DataFrame, results: DataFrame, requests: DataFrame, *, rule: Rule = SIGMA
) -> DataFrame:
    """Result rows for the requested dates and series.

    * No source row: one ``no data`` row with the band, if there is one.
    * Fewer than seven accepted results: the source rows that have a value are
      accepted without bounds.
    * Otherwise the rule decides.

    Requests lacking a key value match nothing. All requests are judged against
    ``results`` as given; none sees the outcome of another.
    """
    source = _on_requested_dates(source.select(*_BY, rule.value), requests)
    bands = request_bands(source, results, requests, rule)
    # A request without source rows is carried by a stand-in row through the same join.
    stand_ins = requests.select(*_BY).distinct().withColumn("stand_in", F.lit(True))
    rows = source.withColumn("stand_in", F.lit(False)).unionByName(
        stand_ins, allowMissingColumns=True
    )
    value, stand_in = F.col(rule.value), F.col("stand_in")
    new = ~stand_in & (F.col("jml") < MIN_ACCEPTED)
    wanted = (
        F.when(stand_in, ~F.col("present") & F.col("has_band"))
        .when(new, value.isNotNull())
        .otherwise(True)
    )
    status = (
        F.when(stand_in, NO_DATA)
        .when(new, OK)
        .otherwise(rule.status(value, F.col("b_bawah"), F.col("b_atas")))
    )
    return (
        rows.join(bands, _BY)
        .where(wanted)
        .select(
            *_BY,
            value,
            *[F.when(~new, F.col(b)).alias(b) for b in BOUNDS],
            status.alias("status"),
        )
    )


def detail_completeness(
    row_counts: DataFrame, results: DataFrame, requests: DataFrame
) -> DataFrame:
    """``detail`` for row counts."""
    return detail(row_counts, results, requests, rule=COMPLETENESS_DETAIL)


def start_completeness(row_counts: DataFrame, results: DataFrame, day) -> DataFrame:
    """Completeness of one day for every series that reports, new ones accepted.

    With no results yet, this is how completeness gets its first baseline.
    """
    rows = row_counts.where(F.col("date") == F.lit(day).cast("date"))
    return detail_completeness(rows, results, rows.select(*_BY))
