"""Small tables kept up to date beside large ones, so that a daily run need not read the past.

``RecentDays`` follows a table of results and has what bands are computed from.
``MisnamedSites`` has the misnamed sites of all row counts that it was fed.
"""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiwarden.functions.dates import as_date
from kpiwarden.functions.rules import OK, SCORE_DEPTH
from kpiwarden.functions.sums import FIELDS, PARTS
from kpiwarden.operators.recent import daily_totals, recent_days
from kpiwarden.operators.selection import misnamed
from kpiwarden.operators.slices import slices
from kpiwarden.sources.schema import KEYS
from kpiwarden.sources.store import CHANGE, FOLLOWED, NEW, DatedTable

_TOTAL = T.StructType([T.StructField(n, T.LongType() if n in PARTS else T.DoubleType()) for n in FIELDS])
_MEASURES = {
    "rows": T.LongType(), "filled": T.LongType(), "total": _TOTAL,
    "low": T.DoubleType(), "high": T.DoubleType(), "spread": T.DoubleType(),
}
RECENT = T.StructType(
    [T.StructField("date", T.DateType())]
    + [T.StructField(k, T.StringType()) for k in KEYS]
    + [T.StructField("day", T.DateType())]
    + [T.StructField(n, t) for n, t in _MEASURES.items()]
)
MISNAMED = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()), T.StructField("days", T.LongType()),
])


class RecentDays:
    """Daily totals of accepted rows that a band can still ask for.

    There is a base date. All totals from it on are here, and of those before it the ones
    whose rows rank ``depth`` or better among the rows of their series and weekday (those
    that do so among all rows of the series are among them). So every band of a day from the
    base on comes out as from the whole results. A change of the results from the base on
    needs the changed dates only; a change before it builds the table again. The base
    follows the last date at a distance of ``spare`` days.

    The table is one folder, named by the base. It is given to the results as ``recent``;
    every change of them then changes both by one marker, and changes made without it are
    refused.
    """

    def __init__(
        self, spark: SparkSession, path: str, value: str = "value", depth: int = SCORE_DEPTH, spare: int = 7
    ):
        self.spark, self.value, self.depth, self.spare = spark, value, depth, spare
        self.table = DatedTable(spark, path, RECENT)

    def start(self, results: DatedTable) -> None:
        """Build the table from all results and have it follow them from now on."""
        results.recover()
        results.recent = self
        results._delete(results._file(CHANGE))
        results._commit([{"path": results.path, "filled": [], "gone": []}])
        results._put_once(FOLLOWED, self.table.path)

    def base(self) -> Date | None:
        """The base date; None while there are no results."""
        self.table.recover()
        return next(iter(self.table.dates()), None)

    def before(self, day: str) -> DataFrame:
        """Totals of the dates before a day, for ``score`` and its likes; an error if the day is before the base."""
        base = self.base()
        if base is not None and Date.fromisoformat(day) < base:
            raise ValueError(f"recent days are kept for scoring from {base} on; score {day} from the results")
        return self._totals().where(F.col("date") < as_date(day)).select("series.*", "date", *_MEASURES)

    def _totals(self) -> DataFrame:
        rows = self.table.read()
        return rows.select(F.struct(*KEYS).alias("series"), F.col("day").alias("date"), *_MEASURES)

    def prepared(self, results: DatedTable, part: dict) -> dict:
        """The change of this table that goes with a prepared change of the results."""
        changed = sorted({*part["filled"], *part["gone"]})
        left = {d.isoformat() for d in results.dates()}.difference(part["gone"]).union(part["filled"])
        base = self.base()
        self.table._delete(self.table._file(CHANGE))
        filled = []
        if left:
            new_base = Date.fromisoformat(max(left)) - timedelta(days=self.spare)
            new_base = new_base if base is None else max(base, new_base)
            totals = self._after(results, part, changed, left, base)
            for of in slices(totals, ["series"]):
                self._write(self._still_asked_for(of(totals), new_base), new_base)
            filled = [d.isoformat() for d in self.table._dates_in(self.table._file(NEW))]
        gone = [] if base is None or base.isoformat() in filled else [base.isoformat()]
        return {"path": self.table.path, "filled": filled, "gone": gone}

    def _after(
        self, results: DatedTable, part: dict, changed: list[str], left: set[str], base: Date | None
    ) -> DataFrame:
        """Daily totals after the change; of dates before the base at least those that rank."""
        other = ~F.col("date").isin([Date.fromisoformat(d) for d in changed])
        fresh = DatedTable(self.spark, results._file(NEW), results.schema).read() if part["filled"] else None
        only_the_oldest_go = bool(changed) and not part["filled"] and min(left) > changed[-1]
        known = base is not None and changed and (changed[0] >= base.isoformat() or only_the_oldest_go)
        if known:
            kept = self._totals().where(other)
            return kept if fresh is None else kept.unionByName(self._daily(fresh))
        rows = results.read().where(other) if changed else results.read()
        return self._daily(rows if fresh is None else rows.unionByName(fresh))

    def _daily(self, rows: DataFrame) -> DataFrame:
        return daily_totals(rows.where(F.col("status") == OK), self.value)

    def _still_asked_for(self, totals: DataFrame, base: Date) -> DataFrame:
        early = totals.where(F.col("date") < F.lit(base))
        by_weekday = early.withColumn("series", F.col("series").withField("weekday", F.dayofweek("date")))
        ranked = recent_days(by_weekday, self.depth)
        ranked = ranked.withColumn("series", F.col("series").dropFields("weekday"))
        return ranked.select(*totals.columns).unionByName(totals.where(F.col("date") >= F.lit(base)))

    def _write(self, totals: DataFrame, base: Date) -> None:
        rows = totals.select(F.lit(base).alias("date"), "series.*", F.col("date").alias("day"), *_MEASURES)
        self.table._write(self.table._filled(rows), self.table._file(NEW))


class MisnamedSites:
    """Names of misnamed sites with the days whose row counts have them.

    A row is a month and a name; its days are the bits of a number. So the days of a month can
    be fed again exactly, and the table grows with months, not with days or rows. Folders are months.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.table = DatedTable(spark, path, MISNAMED)

    def feed(self, row_counts: DataFrame, start: str, end: str) -> None:
        """Take the names of the dates from start to end, both included, in place of those known for them.

        Rows without a date are not looked at.
        """
        first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
        month = F.trunc("date", "month").alias("date")
        fresh = row_counts.where(F.col("date").between(first, last) & misnamed()).select(
            month, "level", "location", _bit(F.dayofmonth("date") - 1).alias("days")
        )
        within = F.col("date").between(F.trunc(first, "month"), last)
        from_day = F.dayofmonth(F.greatest(F.col("date"), first))
        to_day = F.dayofmonth(F.least(F.last_day("date"), last))
        fed = _bit(to_day) - _bit(from_day - 1)
        kept = self.table.read().where(within).withColumn("days", F.col("days").bitwiseAND(F.bitwise_not(fed)))
        rows = fresh.unionByName(kept.where("days <> 0"))
        rows = rows.groupBy("date", "level", "location").agg(F.bit_or("days").alias("days"))
        low, high = Date.fromisoformat(start).replace(day=1), Date.fromisoformat(end)
        with self.table._staged(rows) as staged:
            months = {d for d in self.table.dates() if low <= d <= high}
            self.table._commit([self.table._prepared(None, staged, months)])

    def read(self) -> DataFrame:
        """``level, location`` of every misnamed site, for ``score_completeness`` as ``sites``."""
        return self.table.read().select("level", "location")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)
