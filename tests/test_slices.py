"""Large tables are worked on in slices of series, and shuffle files go when a table is written."""

import random
import time
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import derived
from fixtures import queries as fixture_queries
from kpiwarden.operators import slices as sliced
from kpiwarden.plans import detail as detail_plan
from kpiwarden.plans.maintain import replace_series
from kpiwarden.sources import schema
from kpiwarden.sources.kept import RecentDays
from kpiwarden.sources.store import DatedTable

SF_DIR = "/root/testdata/sf0.001"


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return (date(2024, 1, 1) + timedelta(days=n)).isoformat()


@pytest.fixture
def many(monkeypatch):
    """As many slices as there may be, whatever the size of the files."""

    def start():
        monkeypatch.setattr(sliced, "SLICE_BYTES", 1)

    return start


@pytest.fixture
def written(monkeypatch):
    """The slices that are written, as lists of rows."""
    parts = []

    def stored(df, purpose):
        found = written_by(df, purpose)
        parts.append(found.collect())
        return found

    written_by = sliced.stored
    monkeypatch.setattr(sliced, "stored", stored)
    return parts


def some_keys(make):
    return [make.key(f"S{i:05}", vendor=v, node=n) for i in range(5) for v in ("V", None) for n in ("n", None)]


def some_rows(make, count=False):
    """Results with copies, equal dates, null values and null keys."""
    rng, rows = random.Random(3), []
    for d in range(30):
        for key in some_keys(make):
            value = rng.choice([None, *range(90, 110)])
            value = value if count or value is None else float(value)
            rows += [(day(d), key, value, rng.choice(["ok", "ok", "anomaly"]))] * rng.choice([0, 1, 1, 2])
            rows += [(day(d), key, 5 if count else 5.0, "ok")] * (rng.random() < 0.1)
    return rows


@pytest.fixture
def results(make, spark, tmp_path):
    table = DatedTable(spark, str(tmp_path / "results"), schema.ANOMALY_RESULTS)
    table.append(make.results(some_rows(make)))
    return table


def test_each_row_passes_one_slice_and_a_series_passes_together(results, many):
    rows = results.read()
    assert len(sliced.slices(rows, schema.KEYS)) == 1
    many()
    parts = [bag(of(rows)) for of in sliced.slices(rows, schema.KEYS)]
    assert len(parts) == sliced.MOST_SLICES
    assert sorted((r for p in parts for r in p), key=repr) == bag(rows)
    series = [{r[1:7] for r in p} for p in parts]
    assert sum(map(len, series)) == len(set.union(*series)) == 20


def test_rows_of_unknown_size_are_one_slice(make, many):
    many()
    assert len(sliced.slices(make.results(some_rows(make)), schema.KEYS)) == 1


@pytest.mark.parametrize("count", [False, True])
def test_detail_in_slices(make, spark, tmp_path, many, written, count):
    to = schema.COMPLETENESS_RESULTS if count else schema.ANOMALY_RESULTS
    table = DatedTable(spark, str(tmp_path / "results"), to)
    table.append(make.results(some_rows(make, count), count))
    keys = [*some_keys(make), make.key("S00009")]
    asked = make.requests([(day(d), k) for d in (0, 4, 12, 29, 40) for k in keys])
    source = [(day(d), k, 100 if count else 100.0) for d in (4, 29) for k in keys[1:]]
    source = make.row_counts(source) if count else make.observations(source)
    check = detail_plan.detail_completeness if count else detail_plan.detail
    whole = bag(check(source, table.read(), asked))
    assert whole and not written
    many()
    assert bag(check(source, table.read(), asked)) == whole
    assert len(written) == sliced.MOST_SLICES and sum(map(bool, written)) > 1


@pytest.mark.parametrize("name", ["baseline_sigma", "baseline_rowcount_detail"])
def test_bands_of_distinct_rows_in_slices(spark, many, written, name):
    query = fixture_queries.queries()[name]
    whole = bag(query(spark, SF_DIR))
    assert whole and not written
    many()
    assert bag(query(spark, SF_DIR)) == whole
    assert len(written) == sliced.MOST_SLICES and sum(map(bool, written)) > 1


def test_recent_days_start_in_slices(spark, results, tmp_path, many, monkeypatch):
    started = RecentDays(spark, str(tmp_path / "recent"))
    started.start(results)
    whole = bag(started.table.read())
    many()
    runs = []
    write = RecentDays._write
    monkeypatch.setattr(RecentDays, "_write", lambda self, *a: (runs.append(1), write(self, *a)))
    again = RecentDays(spark, str(tmp_path / "again"))
    again.start(results)
    assert whole and bag(again.table.read()) == whole
    assert len(runs) == sliced.MOST_SLICES


def test_tables_are_stored_in_slices_of_dates(spark, results, many, monkeypatch):
    t = fixture_queries.Tables(spark, SF_DIR)
    whole = fixture_queries._stored_table(t, results.read())
    many()
    runs = []
    append = DatedTable.append
    monkeypatch.setattr(DatedTable, "append", lambda self, rows: (runs.append(1), append(self, rows)))
    parts = fixture_queries._stored_table(t, results.read())
    assert len(runs) == sliced.MOST_SLICES and parts.dates() == whole.dates()
    assert bag(parts.read()) == bag(whole.read()) == bag(results.read())


def test_rows_of_dates_not_asked_for_are_not_shuffled(make, spark, results):
    keys = some_keys(make)
    asked = make.requests([(day(4), keys[0]), (day(4), keys[1]), (day(9), keys[0])])
    fresh = make.results([(day(4), keys[0], 1.0, "ok")])
    table = results.read().unionByName(make.results([(day(4), keys[2], 7.0, "ok")]).withColumn("date", F.lit(None).cast("date")))
    replaced = replace_series(table, fresh, asked)
    gone = {(day(4), keys[0]), (day(9), keys[0])}  # the other lacks a key value
    stay = [tuple(r) for r in table.collect() if (str(r["date"]), tuple(r[1:7])) not in gone]
    assert bag(replaced) == sorted([*stay, *(tuple(r) for r in fresh.collect())], key=repr)
    optimized = replaced._jdf.queryExecution().optimizedPlan().toString().splitlines()
    anti = next(i for i, x in enumerate(optimized) if "LeftAnti" in x)
    assert any("Filter" in x and "date" in x and "IN (" in x for x in optimized[anti : anti + 3])
    nothing = replace_series(table, fresh, asked.limit(0))
    assert bag(nothing) == sorted([*map(tuple, table.collect()), *map(tuple, fresh.collect())], key=repr)


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def left_after(spark, run):
    """Shuffle files that a run leaves; Spark removes them a little later."""
    before = shuffle_files(spark)
    held = run()
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left, held


def test_derived_and_stored_tables_leave_no_shuffle_files(spark, make, tmp_path):
    path = str(tmp_path / "lineitem.parquet")
    spark.read.parquet(f"{SF_DIR}/lineitem.parquet").limit(500).write.parquet(path)
    assert not left_after(spark, lambda: derived.observations(spark, str(tmp_path)))[0]
    table = DatedTable(spark, str(tmp_path / "results"), schema.ANOMALY_RESULTS)
    rows = make.results(some_rows(make)).repartition(3, "location")
    assert not left_after(spark, lambda: (table.append(rows), rows))[0]
    one = rows.where(F.col("date") == day(3))
    assert not left_after(spark, lambda: (table.replace_date(one, day(3)), one))[0]
