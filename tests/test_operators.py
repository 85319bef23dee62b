import random
import statistics
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from kpiwarden.functions.dates import replay_dates, with_day_name
from kpiwarden.functions.rules import COMPLETENESS, PLAIN, SIGMA, TREND
from kpiwarden.operators.bands import series_bands
from kpiwarden.operators.recent import daily_totals, recent_days, recent_rows, recent_totals
from kpiwarden.operators.selection import (
    bad_site_locations,
    not_in_bad_sites,
    outside_bad_sites,
    with_complete_keys,
)
from kpiwarden.plans.score import score, score_all, score_completeness
from kpiwarden.plans.seed import seed
from kpiwarden.sources.schema import OBSERVATIONS, conform

START = date(2024, 1, 1)


def day(i):
    return (START + timedelta(days=i)).isoformat()


def random_history(make, seed, series=6, days=40):
    rng = random.Random(seed)
    rows = []
    for s in range(series):
        key = make.key(f"S{s:05d}", vendor=None if s == 0 else "V")
        for d in range(days):
            for _ in range(rng.choice([0, 0, 1, 1, 1, 2, 5])):
                rows.append((day(d), key, float(rng.randint(1, 50))))
    return rows


def brute_recent(rows, depth):
    """Rows with their rank, per key, newest first."""
    kept = []
    for key in {k for _, k, _ in rows}:
        mine = [r for r in rows if r[1] == key]
        for r in mine:
            rank = 1 + sum(other[0] > r[0] for other in mine)
            if rank <= depth:
                kept.append((*r, rank))
    return kept


@pytest.mark.parametrize("seed", [1, 2])
def test_recent_rows_are_rank_with_ties(make, seed):
    rows = random_history(make, seed)
    got = recent_rows(make.observations(rows), "value", 7).collect()
    found = sorted(
        (r["date"].isoformat(), repr(make.key(r["location"], vendor=r["vendor"])), r["value"], r["rank"])
        for r in got
    )
    assert found == sorted((d, repr(k), v, n) for d, k, v, n in brute_recent(rows, 7))


@pytest.mark.parametrize("rule", [PLAIN, SIGMA])
def test_bands_equal_brute_force(make, rule):
    rows = [(d, k, v + 1e9) for d, k, v in random_history(make, 3)]
    bands = series_bands(recent_days(daily_totals(make.observations(rows), "value"), 7), rule)
    expected = {}
    for _, key, value, _ in brute_recent(rows, 7):
        expected.setdefault(key, []).append(value)
    got = {make.key(r["location"], vendor=r["vendor"]): r for r in bands.collect()}
    assert got.keys() == expected.keys()
    for key, values in expected.items():
        mean = statistics.fmean(values)
        width = 3 * statistics.stdev(values) if rule is SIGMA else mean * 0.1
        assert got[key]["rata"] == pytest.approx(mean, rel=1e-12)
        assert got[key]["b_atas"] - mean == pytest.approx(width, rel=1e-6)
        assert mean - got[key]["b_bawah"] == pytest.approx(width, rel=1e-6)


def test_sigma_band_of_equal_and_of_single_values(make):
    equal, single = make.key("S00001"), make.key("S00002")
    rows = [(day(i), equal, 0.1) for i in range(3)] + [(day(0), single, 5.0)]
    bands = series_bands(recent_days(daily_totals(make.observations(rows), "value"), 7), SIGMA)
    got = {r["location"]: r for r in bands.collect()}
    assert got["S00001"]["b_bawah"] == pytest.approx(0.095)
    assert got["S00001"]["b_atas"] == pytest.approx(0.105)
    assert got["S00002"]["rata"] == 5.0
    assert got["S00002"]["b_bawah"] is None and got["S00002"]["b_atas"] is None


@pytest.mark.parametrize("look_back", [1, 5, 20, 100])
def test_look_back_changes_nothing(make, look_back):
    rows = random_history(make, 4)
    history = make.observations(rows)
    wanted = history.select(*OBSERVATIONS.names[1:7]).distinct().where("vendor is not null")
    full = series_bands(recent_totals(history, "value", 7), PLAIN)
    short = series_bands(
        recent_totals(
            history, "value", 7, wanted=wanted, before=day(40), look_back=look_back
        ),
        PLAIN,
    )
    keep = F.col("vendor").isNotNull()
    assert sorted(map(repr, full.where(keep).collect())) == sorted(
        map(repr, short.where(keep).collect())
    )


@pytest.mark.parametrize("look_back", [3, 15, 100])
@pytest.mark.parametrize("rule", [PLAIN, TREND], ids=["plain", "trend"])
def test_look_back_seeds_the_same_rows(make, look_back, rule):
    source = make.observations(random_history(make, 5, series=4, days=100))
    options = dict(category="ran", rule=rule, up_to=day(95))

    def seeded(**more):
        rows = seed(source, make.kpi_list(rule), make.sites(), **options, **more)
        return sorted(map(repr, rows.collect()))

    assert seeded(look_back=look_back) == seeded()
    assert any("vendor=None" in row for row in seeded())


def test_not_in_keeps_null_locations_only_without_bad_sites(make):
    rows = make.row_counts(
        [(day(0), make.key(loc), 1) for loc in (None, "S00001", "S0000001")]
        + [(day(0), make.key("S0000001", level="city"), 1)]
    )
    bad = make.sites([("site", "S0000001"), ("city", "LONGNAME"), ("site", None)])
    none = make.sites([("site", "S00001"), ("city", "LONGNAME"), ("site", None)])
    assert [r["location"] for r in bad_site_locations(bad).collect()] == ["S0000001"]
    assert [r["location"] for r in not_in_bad_sites(rows, bad).collect()] == ["S00001"]
    assert not_in_bad_sites(rows, none).count() == 4
    assert outside_bad_sites(rows, bad).count() == 2


def test_rows_lacking_a_key_other_than_vendor_are_dropped(make):
    keys = [make.key("S00001"), make.key("S00001", vendor=None)]
    keys += [make.key("S00001", node=None), make.key("S00001", kpi=None), make.key(None)]
    rows = make.observations([(day(0), k, 1.0) for k in keys])
    assert with_complete_keys(rows).count() == 2


def test_day_name_is_trimmed(spark):
    df = spark.createDataFrame([(date(2024, 1, 2), "Tuesday  ")], "date date, day_name string")
    assert with_day_name(df).first()["day_name"] == "Tuesday"
    assert with_day_name(df.drop("day_name")).first()["day_name"] == "Tuesday"


def test_replay_dates(spark):
    assert [str(r["date"]) for r in replay_dates(spark, "2024-02-28", "2024-03-01").collect()] == [
        "2024-02-28", "2024-02-29", "2024-03-01",
    ]
    assert replay_dates(spark, "2024-02-02", "2024-02-01").count() == 0


def test_conform_reports_missing_columns(spark):
    with pytest.raises(ValueError, match="kpi"):
        conform(spark.range(1).withColumn("date", F.current_date()), OBSERVATIONS)


def test_null_vendor_finds_no_band(make):
    keys = [make.key("S00001"), make.key("S00001", vendor=None)]
    history = make.results([(day(0), k, 100.0, "ok") for k in keys])
    today = make.observations([(day(1), k, 100.0) for k in keys])
    scored = score(
        today, history, make.kpi_list(PLAIN), make.sites(),
        category="ran", rule=PLAIN, day=day(1),
    )
    assert {(r["vendor"], r["status"], r["rata"]) for r in scored.collect()} == {
        ("V", "ok", 100.0), (None, "anomaly", None),
    }


def test_kpi_in_two_classes_is_scored_in_both(make, spark):
    from kpiwarden.functions.rules import RATE

    key = make.key("S00001")
    history = make.results([(day(0), key, 150.0, "ok")])
    today = make.observations([(day(1), key, 150.0)])
    both = make.kpi_list(PLAIN).union(make.kpi_list(RATE)).union(make.kpi_list(RATE))
    scored = score_all(today, history, both, make.sites(), category="ran", day=day(1))
    assert sorted((r["rate_status"], r["status"]) for r in scored.collect()) == [
        ("N", "ok"), ("Y", "anomaly"),
    ]


def test_completeness_without_results_is_not_ok(make):
    counts = make.row_counts([(day(1), make.key("S00001"), 10), (day(1), make.key(None), None)])
    scored = score_completeness(counts, make.results([], count=True), day=day(1))
    assert [r["status"] for r in scored.collect()] == ["not ok", "not ok"]
    assert COMPLETENESS.alert == "not ok"
