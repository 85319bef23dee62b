"""Result and history tables: parquet folders partitioned by date.

The new rows of a change are first written to a scratch table: their plan runs once,
their dates are then known, and a change that would reach beyond what it names is
refused before the table is touched. All that the dates concerned will hold, what stays
of them included, is then written beside them, in a folder of the table that readers do
not see. A marker makes the change final; only then do the new folders take the places of
the old ones, one by one. Ended before the marker, the change has not happened and can be
repeated; ended after it, the next use of the table finishes it. No row exists only in
memory or in a job's own files at any time. A change of several tables has one marker.

Changes of a table come one after the other; nothing here keeps two writers apart.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import date as Date
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kpiwarden.functions.dates import as_date
from kpiwarden.functions.rules import CATEGORIES, KEEP_DAYS, Rule
from kpiwarden.operators.selection import of_kpis
from kpiwarden.plans.maintain import without_kpis
from kpiwarden.plans.score import alerts
from kpiwarden.sources.schema import KEYS, conform
from kpiwarden.sources.scratch import scratch_path, shuffles_removed

if TYPE_CHECKING:
    from kpiwarden.sources.kept import RecentDays


#: Folder for what a change will put in place, and the file that makes it final.
CHANGE, NEW, READY = "_change", "_change/new", "_change/ready"

#: File of a table that another follows, see ``RecentDays``.
FOLLOWED = "_followed"


class DatedTable:
    """A parquet folder with one sub-folder per date.

    ``recent`` is what follows this table, if anything does: it changes together with it.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, recent: RecentDays | None = None
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.recent = recent

    def read(self) -> DataFrame:
        """All rows; a filter on ``date`` reads only the folders it needs."""
        self.recover()
        if not self._exists(self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)

    def append(self, rows: DataFrame) -> None:
        """Add rows. Columns the table has and the rows lack become null; a null date fails."""
        self.recover()
        self._refuse_unfollowed()
        if self.recent is None:
            self._write(self._filled(rows), self.path)
            return
        with self._staged(rows) as staged:
            days = staged.dates()
            self._commit([self._prepared(self._on(days), staged, days)])

    def replace_slice(self, fresh: DataFrame, kpis: DataFrame, day: str) -> None:
        """Replace the rows of some KPIs on one date."""
        self.replace_range(fresh, day, day, kpis)

    def replace_date(self, fresh: DataFrame, day: str) -> None:
        """Replace all rows of one date."""
        self.replace_range(fresh, day, day)

    def replace_range(
        self, fresh: DataFrame, start: str, end: str, kpis: DataFrame | None = None
    ) -> None:
        """Replace all rows, or those of some KPIs, on the dates from start to end, both included.

        Fresh rows of other dates or KPIs are refused.
        """
        self._commit([self._prepared_range(fresh, start, end, kpis)])

    def _prepared_range(
        self, fresh: DataFrame, start: str, end: str, kpis: DataFrame | None
    ) -> dict:
        """The change that ``replace_range`` makes, prepared."""
        first, last = Date.fromisoformat(start), Date.fromisoformat(end)
        with self._staged(fresh) as staged:
            found = staged.dates()
            if found and not first <= found[0] <= found[-1] <= last:
                raise ValueError(f"rows dated {found[0]} to {found[-1]} cannot replace {start} to {end}")
            days = {d for d in self.dates() if first <= d <= last}
            if kpis is None:
                return self._prepared(None, staged, days)
            staged.refuse_others(kpis.select("kpi"))
            return self._prepared(without_kpis(self._on(days), kpis), staged, days)

    def replace_series(self, fresh: DataFrame, requests: DataFrame) -> None:
        """Replace the rows of the requested dates and series; other fresh rows are refused."""
        asked = requests.select("date", *KEYS).distinct()
        with self._staged(fresh) as staged:
            staged.refuse_others(asked)
            days = set(_dates(requests))
            kept = self._on(days).join(asked, asked.columns, "left_anti")
            self._commit([self._prepared(kept.select(*self.schema.names), staged, days)])

    def reseed(self, fresh: DataFrame, kpis: DataFrame) -> None:
        """Replace all rows of some KPIs, touching only dates that have or get any; others are refused."""
        with self._staged(fresh) as staged:
            staged.refuse_others(kpis.select("kpi"))
            days = {*_dates(of_kpis(self.read(), kpis)), *staged.dates()}
            self._commit([self._prepared(without_kpis(self._on(days), kpis), staged, days)])

    def retain(self, as_of: str, keep_days: int = KEEP_DAYS) -> None:
        """Remove the folders of dates ``keep_days`` or more before ``as_of``."""
        self.recover()
        self._refuse_unfollowed()
        last = Date.fromordinal(Date.fromisoformat(as_of).toordinal() - keep_days)
        old = [day for day in self.dates() if day <= last]
        if self.recent is not None and old:
            self._delete(self._file(CHANGE))
            self._commit([{"path": self.path, "filled": [], "gone": [d.isoformat() for d in old]}])
            return
        for day in old:
            self._delete(self._folder(day))

    def dates(self) -> list[Date]:
        """Dates the table has folders for, read from their names."""
        return self._dates_in(self.path)

    def _dates_in(self, path: str) -> list[Date]:
        if not self._exists(path):
            return []
        folders = self._fs(path).listStatus(self._path(path))
        names = [f.getPath().getName() for f in folders]
        return sorted(
            Date.fromisoformat(n[5:]) for n in names if re.fullmatch(r"date=\d{4}-\d\d-\d\d", n)
        )

    def refuse_others(self, allowed: DataFrame) -> None:
        """Raise if a row lies outside ``allowed``, given by some of its columns."""
        if not self.read().join(allowed, allowed.columns, "left_anti").isEmpty():
            raise ValueError(f"rows outside the given {', '.join(allowed.columns)}")

    def _on(self, days: Iterable[Date]) -> DataFrame:
        return self.read().where(F.col("date").isin(sorted(days)))

    @contextmanager
    def _staged(self, fresh: DataFrame) -> Iterator[DatedTable]:
        """The fresh rows as a scratch table, removed in the end."""
        self.recover()
        staged = DatedTable(self.spark, scratch_path(self.spark, "staged"), self.schema)
        rows = staged._filled(fresh)
        try:
            with shuffles_removed(self.spark):
                rows.write.partitionBy("date").parquet(staged.path)
            yield staged
        finally:
            self._delete(staged.path)

    def recover(self) -> None:
        """Finish a change that was final when its run ended."""
        ready = self._file(READY)
        if self._exists(ready):
            self._finish(json.loads(self._text(ready)))
            return
        partner = self._file(f"{CHANGE}/with")
        if self._exists(partner):
            first = DatedTable(self.spark, self._text(partner), self.schema)
            if self._exists(first._file(READY)):
                first.recover()

    def _prepared(self, kept: DataFrame | None, staged: DatedTable, days: Iterable[Date]) -> dict:
        """What makes the given dates hold the kept and the staged rows, and nothing else, written beside them."""
        self._delete(self._file(CHANGE))
        content = staged.read() if kept is None else staged.read().unionByName(kept)
        self._write(content, self._file(NEW))
        filled = [d.isoformat() for d in self._dates_in(self._file(NEW))]
        gone = [d.isoformat() for d in days if d.isoformat() not in filled]
        return {"path": self.path, "filled": filled, "gone": sorted(gone)}

    def _commit(self, parts: list[dict]) -> None:
        """Make prepared changes final, this table's first, and put them in place."""
        self._refuse_unfollowed()
        if self.recent is not None:
            parts = [*parts, self.recent.prepared(self, parts[0])]
        for part in parts[1:]:
            self._put(f"{part['path']}/{CHANGE}/with", self.path)
        self._put(self._file(READY), json.dumps(parts))
        self._finish(parts)

    def _refuse_unfollowed(self) -> None:
        """Raise if another table follows this one and would not learn of a change."""
        if self.recent is None and self._exists(self._file(FOLLOWED)):
            raise ValueError(f"{self.path} is followed by {self._text(self._file(FOLLOWED))}: open it with recent=")

    def _finish(self, parts: list[dict]) -> None:
        """Put new folders in the places of the old; what an earlier run has moved is left as it is."""
        for part in parts:
            for day in part["filled"]:
                self._move(f"{part['path']}/{NEW}/date={day}", f"{part['path']}/date={day}")
            for day in part["gone"]:
                self._delete(f"{part['path']}/date={day}")
        for part in reversed(parts):  # this table's, with the marker, last
            left = self._dates_in(f"{part['path']}/{NEW}")
            if left:
                raise RuntimeError(f"{part['path']}: {len(left)} dates are not in place")
            self._delete(f"{part['path']}/{CHANGE}")

    def _move(self, source: str, target: str) -> None:
        if self._exists(source):
            self._delete(target)
            if not self._fs(source).rename(self._path(source), self._path(target)):
                raise OSError(f"cannot move {source}")

    def _put(self, path: str, text: str) -> None:
        """A small file, there as a whole or not at all."""
        fs, draft = self._fs(path), self._path(f"{path}.draft")
        out = fs.create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(draft, self._path(path)):
            raise OSError(f"cannot write {path}")

    def _put_once(self, name: str, text: str) -> None:
        """A small file of the table in place of one of that name."""
        self._delete(self._file(name))
        self._put(self._file(name), text)

    def _text(self, path: str) -> str:
        source = self._fs(path).open(self._path(path))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()

    def _file(self, name: str) -> str:
        return f"{self.path}/{name}"

    def _filled(self, rows: DataFrame) -> DataFrame:
        missing = [f for f in self.schema if f.name not in rows.columns]
        for field in missing:
            rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        dated = F.coalesce("date", F.raise_error(F.lit("a stored row needs a date")).cast("date"))
        return conform(rows, self.schema).withColumn("date", dated)

    def _write(self, rows: DataFrame, path: str) -> None:
        """Add rows by date. Rebalancing gives few files per date and splits large dates."""
        with shuffles_removed(self.spark):
            rows.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)

    def _folder(self, day: Date) -> str:
        return f"{self.path}/date={day.isoformat()}"

    # Spark has no call that removes a folder, so the storage client it uses is asked.
    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return self._path(path).getFileSystem(conf)

    def _exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def _delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)


def _dates(df: DataFrame) -> list[Date]:
    """Distinct dates; there are no more than calendar days."""
    return [r["date"] for r in df.select("date").distinct().where("date is not null").collect()]


def retain_histories(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    as_of: str,
    categories: Iterable[str] = CATEGORIES,
    keep_days: int = KEEP_DAYS,
) -> None:
    """Retention for the history of every category, stored as ``root/h_category``."""
    for category in categories:
        DatedTable(spark, f"{root}/h_{category}", schema).retain(as_of, keep_days)


def publish_day(
    results: DatedTable,
    history: DatedTable,
    scored: DataFrame,
    rule: Rule,
    day: str,
    kpis: DataFrame | None = None,
) -> None:
    """Store one scored day: all rows as results, the alerts as history.

    Rows of the same date are replaced in both tables, those of ``kpis`` only if
    given. The history is taken from the results as they will be, so nothing is scored
    twice. One marker makes both changes final: after a run that ended in between, the
    next use of either table brings both up to date.
    """
    publish_range(results, history, scored, rule, day, day, kpis)


def publish_range(
    results: DatedTable,
    history: DatedTable,
    scored: DataFrame,
    rule: Rule,
    start: str,
    end: str,
    kpis: DataFrame | None = None,
) -> None:
    """``publish_day`` for all dates from start to end, both included, as a replay gives them."""
    first = results._prepared_range(scored, start, end, kpis)
    prepared = DatedTable(results.spark, results._file(NEW), results.schema)
    within = F.col("date").between(as_date(start), as_date(end))
    fresh = alerts(prepared.read().where(within), rule)
    fresh = fresh if kpis is None else of_kpis(fresh, kpis)
    second = history._prepared_range(fresh, start, end, kpis)
    results._commit([first, second])
