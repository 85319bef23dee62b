"""Changes of stored tables that end half way lose no row."""

import pytest
from pyspark.sql import functions as F

from kpiwarden.functions.rules import PLAIN
from kpiwarden.sources import store
from kpiwarden.sources.schema import ANOMALY_RESULTS
from kpiwarden.sources.store import DatedTable, publish_range

DAYS = ("2024-01-01", "2024-01-02", "2024-01-03")


class Ended(Exception):
    pass


def rows_of(table):
    return sorted((r["date"].isoformat(), r["kpi"], r["value"], r["status"]) for r in table.read().collect())


def results(make, values, status="ok"):
    return make.results([(d, make.key("S00001", kpi=k), v, status) for d, k, v in values])


@pytest.fixture
def table(spark, make, tmp_path):
    found = DatedTable(spark, str(tmp_path / "results"), ANOMALY_RESULTS)
    found.append(results(make, [(d, k, 1.0) for d in DAYS for k in ("a", "b")]))
    return found


def end_after(monkeypatch, moves):
    """Let the run end when that many folders are in place."""
    done, move = [], DatedTable._move

    def counted(self, source, target):
        if len(done) == moves:
            raise Ended
        done.append(target)
        move(self, source, target)

    monkeypatch.setattr(DatedTable, "_move", counted)


@pytest.mark.parametrize("moves", [0, 1, 2])
def test_a_change_that_ends_between_partitions_is_finished(spark, make, table, monkeypatch, moves):
    kpis = spark.createDataFrame([("a",)], "kpi string")
    fresh = results(make, [(d, "a", 2.0) for d in DAYS])
    with monkeypatch.context() as m:
        end_after(m, moves)
        with pytest.raises(Ended):
            table.replace_range(fresh, DAYS[0], DAYS[2], kpis)
    again = DatedTable(spark, table.path, ANOMALY_RESULTS)
    want = sorted((d, k, v, "ok") for d in DAYS for k, v in (("a", 2.0), ("b", 1.0)))
    assert rows_of(again) == want
    assert not again._exists(again._file(store.CHANGE))
    again.replace_range(fresh, DAYS[0], DAYS[2], kpis)
    assert rows_of(again) == want


def test_a_change_that_ends_before_its_marker_has_not_happened(spark, make, table, monkeypatch):
    before = rows_of(table)
    with monkeypatch.context() as m:
        m.setattr(DatedTable, "_put", lambda self, path, text: (_ for _ in ()).throw(Ended()))
        with pytest.raises(Ended):
            table.replace_date(results(make, [(DAYS[1], "c", 5.0)]), DAYS[1])
    assert rows_of(table) == before
    table.replace_date(results(make, [(DAYS[1], "c", 5.0)]), DAYS[1])
    assert (DAYS[1], "c", 5.0, "ok") in rows_of(table) and len(rows_of(table)) == 5


@pytest.mark.parametrize("first", ["results", "history"])
def test_results_and_history_end_up_alike(spark, make, table, monkeypatch, first):
    """The run ends when the results are in place and the history is not."""
    history = DatedTable(spark, table.path.replace("results", "history"), ANOMALY_RESULTS)
    history.append(results(make, [(DAYS[0], "a", 1.0), (DAYS[1], "z", 9.0)], "anomaly"))
    scored = results(make, [(DAYS[0], "a", 3.0), (DAYS[1], "a", 3.0)]).unionByName(
        results(make, [(DAYS[1], "b", 4.0)], "anomaly")
    )
    with monkeypatch.context() as m:
        end_after(m, 2)
        with pytest.raises(Ended):
            publish_range(table, history, scored, PLAIN, DAYS[0], DAYS[1])
    again = {n: DatedTable(spark, t.path, ANOMALY_RESULTS) for n, t in (("results", table), ("history", history))}
    again[first].recover()
    assert not any(t._exists(t._file(store.CHANGE)) for t in again.values())
    assert rows_of(again["history"]) == [(DAYS[1], "b", 4.0, "anomaly")]
    assert [r[2] for r in rows_of(again["results"]) if r[0] != DAYS[2]] == [3.0, 3.0, 4.0]
    assert again["results"].read().where(F.col("status") == "anomaly").count() == 1
