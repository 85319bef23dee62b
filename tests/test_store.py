from datetime import date

import pytest

from kpiwarden.functions.rules import COMPLETENESS, PLAIN
from kpiwarden.plans.score import score, score_completeness
from kpiwarden.plans.seed import seed
from kpiwarden.sources import schema
from kpiwarden.sources.store import DatedTable, publish_day, publish_range, retain_histories


@pytest.fixture
def tables(spark, tmp_path):
    return [
        DatedTable(spark, str(tmp_path / name), schema.ANOMALY_RESULTS)
        for name in ("results", "history")
    ]


def rows_of(table):
    return sorted(
        ((str(r["date"]), r["kpi"], r["location"], r["value"], r["status"])
         for r in table.read().collect()),
        key=repr,
    )


def test_publishing_twice_is_publishing_once(make, tables):
    results, history = tables
    a, b = make.key("S00001", kpi="a"), make.key("S00001", kpi="b")
    results.append(
        make.results(
            [("2024-01-01", a, 100.0, "ok"), ("2024-01-01", b, 5.0, "ok"),
             ("2024-01-02", a, 3.0, "anomaly"), ("2024-01-02", b, 7.0, "ok")]
        )
    )
    history.append(make.results([("2024-01-02", b, 9.0, "anomaly")]))
    today = make.observations([("2024-01-02", a, 101.0), ("2024-01-02", a, 300.0)])
    kpi_list = make.kpi_list(PLAIN, ["a"])
    kpis = kpi_list.select("kpi")
    for _ in range(2):
        scored = score(
            today, results.read(), kpi_list, make.sites(),
            category="ran", rule=PLAIN, day="2024-01-02",
        )
        publish_day(results, history, scored, PLAIN, "2024-01-02", kpis)
        assert rows_of(results) == [
            ("2024-01-01", "a", "S00001", 100.0, "ok"),
            ("2024-01-01", "b", "S00001", 5.0, "ok"),
            ("2024-01-02", "a", "S00001", 101.0, "ok"),
            ("2024-01-02", "a", "S00001", 300.0, "anomaly"),
            ("2024-01-02", "b", "S00001", 7.0, "ok"),
        ]
        assert rows_of(history) == [
            ("2024-01-02", "a", "S00001", 300.0, "anomaly"),
            ("2024-01-02", "b", "S00001", 9.0, "anomaly"),
        ]


def test_date_left_without_rows_loses_its_folder(make, tables):
    results, _ = tables
    key = make.key("S00001")
    results.append(make.results([("2024-01-01", key, 1.0, "ok"), ("2024-01-02", key, 2.0, "ok")]))
    results.replace_slice(make.results([]), make.kpi_list(PLAIN, ["k"]), "2024-01-02")
    assert results.dates() == [date(2024, 1, 1)]
    results.replace_date(make.results([]), "2024-01-01")
    assert results.dates() == [] and rows_of(results) == []


def test_reseed_replaces_a_class_on_all_dates(make, tables):
    results, _ = tables
    a, b = make.key("S00001", kpi="a"), make.key("S00001", kpi="b")
    results.append(
        make.results(
            [("2024-01-01", a, 1.0, "ok"), ("2024-01-02", a, 2.0, "anomaly"),
             ("2024-01-02", b, 3.0, "ok"), ("2024-01-03", b, 4.0, "ok")]
        )
    )
    kpi_list = make.kpi_list(PLAIN, ["a"])
    source = make.observations([("2024-01-02", a, 10.0), ("2024-01-04", a, 20.0)])
    for _ in range(2):
        seeds = seed(
            source, kpi_list, make.sites(), category="ran", rule=PLAIN, up_to="2024-01-04"
        )
        results.reseed(seeds, kpi_list.select("kpi"))
        assert rows_of(results) == [
            ("2024-01-02", "a", "S00001", 10.0, "ok"),
            ("2024-01-02", "b", "S00001", 3.0, "ok"),
            ("2024-01-03", "b", "S00001", 4.0, "ok"),
            ("2024-01-04", "a", "S00001", 20.0, "ok"),
        ]
    assert results.dates() == [date(2024, 1, d) for d in (2, 3, 4)]


def test_replace_series(make, tables):
    results, _ = tables
    a, b = make.key("S00001"), make.key("S00002")
    none = make.key("S00003", vendor=None)
    results.append(make.results([("2024-01-01", k, 1.0, "ok") for k in (a, b, none)]))
    asked = make.requests([("2024-01-01", a), ("2024-01-01", none), ("2024-01-02", b)])
    results.replace_series(make.results([("2024-01-01", a, 8.0, "anomaly")]), asked)
    assert rows_of(results) == [
        ("2024-01-01", "k", "S00001", 8.0, "anomaly"),
        ("2024-01-01", "k", "S00002", 1.0, "ok"),
        ("2024-01-01", "k", "S00003", 1.0, "ok"),
    ]


def test_retention_drops_the_day_exactly_31_days_back(make, tables):
    _, history = tables
    key = make.key("S00001")
    days = ["2023-12-31", "2024-01-01", "2024-01-02"]
    history.append(make.results([(d, key, 1.0, "anomaly") for d in days]))
    history.retain("2024-02-01")
    assert [str(d) for d in history.dates()] == ["2024-01-02"]


def test_retention_of_all_categories(spark, make, tmp_path):
    for category in ("core", "vas"):
        table = DatedTable(spark, f"{tmp_path}/h_{category}", schema.ANOMALY_RESULTS)
        table.append(
            make.results([(d, make.key("S00001"), 1.0, "anomaly") for d in ("2024-01-01", "2024-01-02")])
        )
    retain_histories(spark, str(tmp_path), schema.ANOMALY_RESULTS, "2024-02-01")
    for category in ("core", "vas"):
        table = DatedTable(spark, f"{tmp_path}/h_{category}", schema.ANOMALY_RESULTS)
        assert [str(d) for d in table.dates()] == ["2024-01-02"]


def test_completeness_history_takes_not_ok_only(spark, make, tmp_path):
    results, history = (
        DatedTable(spark, str(tmp_path / n), schema.COMPLETENESS_RESULTS) for n in ("r", "h")
    )
    key = make.key("S00001")
    results.append(make.results([("2024-01-01", key, 100, "ok")], count=True))
    counts = make.row_counts([("2024-01-02", key, n) for n in (100, 200, 50)])
    scored = score_completeness(counts, results.read(), day="2024-01-02")
    publish_day(results, history, scored, COMPLETENESS, "2024-01-02")
    assert [(r["row_count"], r["status"]) for r in history.read().collect()] == [(50, "not ok")]
    assert results.read().count() == 4


def three_days_of(make, kpi):
    return make.results([(f"2024-01-0{d}", make.key("S00001", kpi=kpi), float(d), "ok") for d in (1, 2, 3)])


def test_rows_of_other_dates_and_kpis_are_refused(make, tables):
    results, _ = tables
    results.append(three_days_of(make, "b"))
    before = rows_of(results)
    a, b = (make.key("S00001", kpi=k) for k in "ab")
    two_days = make.results([("2024-01-01", a, 1.0, "ok"), ("2024-01-02", a, 1.0, "ok")])
    of_a, of_b = (make.kpi_list(PLAIN, [k]).select("kpi") for k in "ab")
    asked = make.requests([("2024-01-02", a)])
    for change in (
        lambda: results.replace_slice(two_days, of_a, "2024-01-02"),
        lambda: results.replace_slice(make.results([("2024-01-02", b, 1.0, "ok")]), of_a, "2024-01-02"),
        lambda: results.replace_date(two_days, "2024-01-02"),
        lambda: results.replace_series(two_days, asked),
        lambda: results.reseed(two_days, of_b),
        lambda: results.replace_range(two_days, "2024-01-02", "2024-01-31", of_a),
    ):
        with pytest.raises(ValueError):
            change()
        assert rows_of(results) == before


def test_rows_without_a_date_are_refused(spark, make, tables):
    results, _ = tables
    results.append(three_days_of(make, "b"))
    before = rows_of(results)
    undated = spark.createDataFrame([(None, *make.key("S1", kpi="a"), 1.0, None, None, None, "ok")], schema.ANOMALY_RESULTS)
    of_a = make.kpi_list(PLAIN, ["a"]).select("kpi")
    for change in (
        lambda: results.append(undated),
        lambda: results.replace_date(undated, "2024-01-02"),
        lambda: results.replace_slice(undated, of_a, "2024-01-02"),
        lambda: results.reseed(undated, of_a),
    ):
        with pytest.raises(Exception, match="needs a date"):
            change()
        assert rows_of(results) == before


@pytest.mark.parametrize("with_kpis", [True, False])
def test_publish_range(make, tables, with_kpis):
    results, history = tables
    results.append(three_days_of(make, "a").unionByName(three_days_of(make, "b")))
    history.append(make.results([("2024-01-02", make.key("S00001", kpi="b"), 9.0, "anomaly")]))
    a = make.key("S00001", kpi="a")
    scored = make.results([("2024-01-02", a, 50.0, "anomaly"), ("2024-01-03", a, 60.0, "ok")])
    kpis = make.kpi_list(PLAIN, ["a"]).select("kpi") if with_kpis else None
    for _ in range(2):
        publish_range(results, history, scored, PLAIN, "2024-01-02", "2024-01-03", kpis)
        others = [("2024-01-02", "b", "S00001", 2.0, "ok"), ("2024-01-03", "b", "S00001", 3.0, "ok")]
        assert rows_of(results) == sorted(
            [
                ("2024-01-01", "a", "S00001", 1.0, "ok"),
                ("2024-01-01", "b", "S00001", 1.0, "ok"),
                ("2024-01-02", "a", "S00001", 50.0, "anomaly"),
                ("2024-01-03", "a", "S00001", 60.0, "ok"),
                *(others if with_kpis else []),
            ],
            key=repr,
        )
        older = [("2024-01-02", "b", "S00001", 9.0, "anomaly")] if with_kpis else []
        assert rows_of(history) == [("2024-01-02", "a", "S00001", 50.0, "anomaly"), *older]


def test_reseed_runs_the_seed_plan_once(spark, make, tables):
    results, _ = tables
    results.append(three_days_of(make, "b"))
    runs = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    fresh = three_days_of(make, "a").coalesce(1)
    results.reseed(fresh.mapInArrow(seen, fresh.schema), make.kpi_list(PLAIN, ["a"]).select("kpi"))
    assert runs.value == 3 and len(rows_of(results)) == 6
