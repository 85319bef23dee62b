"""The most recent rows of each series, by rank over dates.

Ranks have gaps: rows of one date share a rank, and the rank of a date is one
plus the number of rows on later dates. Ranking the rows themselves would bring
all rows of a series into one task. Instead the rows are first summed up per
series and date, which partly happens before the shuffle, and the running count
of later rows is taken over at most one total per calendar day.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiwarden.functions.dates import as_date
from kpiwarden.functions.sums import as_double, total_of, total_of_totals
from kpiwarden.sources.schema import KEYS
from kpiwarden.sources.scratch import stored


# Windows and groupings over series lead with a hash: sorting then compares one number,
# not six strings, unless two rows are of the same series.
SERIES = ("series_hash", "series")


def with_series_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("series_hash", F.xxhash64("series"))


def daily_totals(rows: DataFrame, value: str, by: Sequence[str] = KEYS) -> DataFrame:
    """One row per series and date with what bands are computed from.

    The series is one struct column. Totals that a caller does not use are
    pruned by the optimizer.
    """
    v = F.col(value).cast("double")
    return rows.groupBy(F.struct(*by).alias("series"), "date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(v).alias("filled"),
        total_of(v).alias("total"),
        F.min(v).alias("low"),
        F.max(v).alias("high"),
        (F.var_pop(v) * F.count(v)).alias("spread"),
    )


def recent_days(totals: DataFrame, depth: int) -> DataFrame:
    """Daily totals whose rows rank among the ``depth`` most recent, with ``rank``.

    A date has at least one row, so no more than ``depth`` dates can rank. Tasks drop
    the others before the shuffle.
    """
    latest_first = Window.partitionBy(*SERIES).orderBy(F.desc("date"))
    latest = with_series_hash(totals).withColumn("place", F.row_number().over(latest_first))
    later = latest_first.rowsBetween(Window.unboundedPreceding, -1)
    rank = F.coalesce(F.sum("rows").over(later), F.lit(0)) + 1
    latest = latest.where(F.col("place") <= depth).drop("place")
    return latest.withColumn("rank", rank).where(F.col("rank") <= depth)


def in_turn(days: DataFrame) -> DataFrame:
    """Asked days as a question (turn 0) and every day with rows as an answer (turn 1), with ``place``.

    ``days`` has a row per series, with its hash, and date: ``rows``, what they add up to,
    and whether the day is ``asked`` for. A day's place is the number of rows up to and
    with it, a question's the number before its date. So what ranks before a question
    are the answers whose place is less than the depth behind its own.
    """
    turns = F.when(F.col("asked"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    days = days.withColumn("turn", F.explode(turns)).where("turn = 0 or rows > 0")
    in_order = Window.partitionBy(*SERIES).orderBy("date", "turn").rowsBetween(Window.unboundedPreceding, 0)
    place = F.sum(F.when(F.col("turn") == 1, F.col("rows")).otherwise(0)).over(in_order)
    return days.withColumn("place", place)


def means_before(days: DataFrame, depth: int) -> DataFrame:
    """The asked days of ``days`` (see ``in_turn``) with ``rata``, the mean of the ``depth`` latest rows before each.

    It is a sum over a range of places; nothing is listed.
    """
    latest = Window.partitionBy(*SERIES).orderBy("place").rangeBetween(1 - depth, 0)
    answer = F.col("turn") == 1
    total = total_of_totals("total", lambda part: F.sum(F.when(answer, part)).over(latest))
    mean = F.try_divide(as_double(total), F.sum(F.when(answer, F.col("filled"))).over(latest))
    return in_turn(days).withColumn("rata", mean).where("turn = 0").drop("turn", "place")


def same_series(left: DataFrame, right: DataFrame, by: Sequence[str], prefix: str = "") -> Column:
    """Join condition on the key columns; only the vendor may be null, and then equals null."""
    on = F.lit(True)
    for k in by:
        mine, theirs = left[k], right[prefix + k]
        on = on & (mine.eqNullSafe(theirs) if k == "vendor" else mine == theirs)
    return on


def recent_rows(
    rows: DataFrame, value: str, depth: int, by: Sequence[str] = KEYS
) -> DataFrame:
    """The rows ranked ``depth`` or better within their series, with ``rank``.

    Only the vendor may be null among ``by``. The ranked days are joined back by
    series and date, where a date with very many rows can be split.
    """
    days = recent_days(daily_totals(rows, value, by), depth)
    days = days.select(
        *[F.col(f"series.{k}").alias(f"_{k}") for k in by], F.col("date").alias("_date"), "rank"
    )
    on = (rows["date"] == days["_date"]) & same_series(rows, days, by, "_")
    return rows.join(days, on).select(*[rows[c] for c in rows.columns], "rank")


def enough_rows(
    rows: DataFrame,
    depth: int,
    by: Sequence[str],
    *,
    wanted: DataFrame,
    before: str | Date,
    look_back: int,
) -> DataFrame:
    """Rows dated before ``before``, less old ones that cannot be among the most recent.

    Rows of the last ``look_back`` days stay. Older dates are read only if some
    ``wanted`` series have fewer than ``depth`` rows in those days, and then only
    for these series. Their list is written to the scratch folder, so that Spark
    knows its size when it chooses how to join the old rows with it.
    """
    since = F.date_sub(as_date(before), look_back)
    near = rows.where((F.col("date") >= since) & (F.col("date") < as_date(before)))
    series = F.struct(*by).alias("series")
    counts = near.groupBy(series).agg(F.count(F.lit(1)).alias("n"))
    short = (
        wanted.select(series)
        .distinct()
        .join(counts.where(F.col("n") >= depth), "series", "left_anti")
        .select("series.*")
    )
    short = stored(short, "short-series")
    if short.isEmpty():
        return near
    old = rows.where(F.col("date") < since)
    return near.unionByName(old.join(short, same_series(old, short, by), "left_semi"))


def recent_totals(
    history: DataFrame,
    value: str,
    depth: int,
    by: Sequence[str] = KEYS,
    *,
    wanted: DataFrame | None = None,
    before: str | Date | None = None,
    look_back: int | None = None,
) -> DataFrame:
    """Ranked daily totals of a history; ``look_back`` as in ``enough_rows``.

    With ``look_back`` only the ``wanted`` series are sure to be complete.
    """
    if look_back is not None:
        history = enough_rows(
            history, depth, by, wanted=wanted, before=before, look_back=look_back
        )
    return recent_days(daily_totals(history, value, by), depth)


def accepted_counts(results: DataFrame, by: Sequence[str] = KEYS) -> DataFrame:
    """Number of accepted rows per series, as ``jml``."""
    return results.where(F.col("status") == "ok").groupBy(*by).agg(F.count(F.lit(1)).alias("jml"))
