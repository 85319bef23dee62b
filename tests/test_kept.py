"""Tables kept up to date beside large ones give what the large ones give."""

import random
from datetime import date, timedelta

import pytest

from kpiwarden.functions.rules import CLASS_RULES, COMPLETENESS, PLAIN
from kpiwarden.operators.selection import not_in_bad_sites
from kpiwarden.plans.score import score, score_all, score_completeness
from kpiwarden.sources.kept import MisnamedSites, RecentDays
from kpiwarden.sources.schema import ANOMALY_RESULTS, COMPLETENESS_RESULTS, KPI_LIST
from kpiwarden.sources.store import DatedTable, publish_day

KPIS = {rule.name: rule for rule in CLASS_RULES}


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def day(n):
    return (date(2024, 1, 1) + timedelta(days=n)).isoformat()


def some_results(make, rng, days, count=False):
    """Some days of some series lack rows, some have more than a band asks for, some rows are not accepted."""
    keys = [make.key(f"S0000{i}", kpi=k) for i in range(3) for k in KPIS]
    rows = []
    for d in days:
        for key in keys:
            for _ in range(rng.choice([0, 1, 1, 1, 2, 9])):
                value = rng.choice([None, rng.randint(90, 110)])
                value = value if count or value is None else float(value)
                rows.append((d, key, value, rng.choice(["ok", "ok", "ok", "anomaly"])))
    return make.results(rows, count)


@pytest.fixture
def followed(spark, make, tmp_path):
    results = DatedTable(spark, str(tmp_path / "results"), ANOMALY_RESULTS)
    results.append(some_results(make, random.Random(1), [day(n) for n in range(0, 60, 2)]))
    recent = RecentDays(spark, str(tmp_path / "recent"), spare=4)
    recent.start(results)
    return results, recent


def assert_same_scores(spark, make, results, recent, days):
    kpi_list = spark.createDataFrame(
        [(n, "include", r.rate_status, r.trend, "ran") for n, r in KPIS.items()], KPI_LIST
    )
    for d in days:
        keys = [make.key(f"S0000{i}", kpi=k) for i in range(4) for k in KPIS]
        args = [kpi_list, make.sites()]
        today = make.observations([(d, k, 100.0) for k in keys])
        want = score_all(today, results.read(), *args, category="ran", day=d)
        got = score_all(today, None, *args, category="ran", day=d, recent=recent.before(d))
        assert bag(got) == bag(want)


def test_scores_are_those_of_the_results_after_any_change(spark, make, followed):
    results, recent = followed
    rng = random.Random(2)
    assert recent.base() == date.fromisoformat(day(54))
    assert_same_scores(spark, make, results, recent, [day(54), day(60)])

    def published(d):
        fresh = some_results(make, rng, [d])
        history = DatedTable(spark, results.path.replace("results", "history"), ANOMALY_RESULTS)
        publish_day(results, history, fresh, PLAIN, d)

    published(day(60))  # a new day
    published(day(60))  # the same again
    assert recent.base() == date.fromisoformat(day(56))
    assert_same_scores(spark, make, results, recent, [day(56), day(61)])
    results.replace_date(results.read().limit(0), day(60))  # a day goes
    results.append(some_results(make, rng, [day(61), day(59), day(61)]))
    assert_same_scores(spark, make, results, recent, [day(57), day(62)])
    results.replace_range(some_results(make, rng, [day(41), day(42)]), day(40), day(45))  # days before the base
    assert_same_scores(spark, make, results, recent, [day(62)])
    kpis = spark.createDataFrame([("plain",)], "kpi string")
    results.reseed(some_results(make, rng, [day(50), day(55)]).where("kpi = 'plain'"), kpis)
    assert_same_scores(spark, make, results, recent, [day(62)])
    results.retain(day(62), keep_days=20)
    assert min(results.dates()) > date.fromisoformat(day(42))
    assert_same_scores(spark, make, results, recent, [day(62)])


def test_one_class_and_row_counts(spark, make, tmp_path, followed):
    results, recent = followed
    today = make.observations([(day(60), make.key("S00001", kpi="trend"), 100.0)])
    rule = KPIS["trend"]
    args = [make.kpi_list(rule, ["trend"]), make.sites()]
    want = score(today, results.read(), *args, category="ran", rule=rule, day=day(60))
    got = score(today, None, *args, category="ran", rule=rule, day=day(60), recent=recent.before(day(60)))
    assert bag(got) == bag(want) and got.count() == 1

    counts = DatedTable(spark, str(tmp_path / "counts"), COMPLETENESS_RESULTS)
    counts.append(some_results(make, random.Random(3), [day(n) for n in range(20)], count=True))
    kept = RecentDays(spark, str(tmp_path / "kept"), "row_count")
    kept.start(counts)
    rows = make.row_counts([(day(20), make.key(f"S0000{i}", kpi="plain"), 100) for i in range(4)])
    want = score_completeness(rows, counts.read(), make.sites(), day=day(20), rule=COMPLETENESS)
    got = score_completeness(rows, None, make.sites(), day=day(20), rule=COMPLETENESS, recent=kept.before(day(20)))
    assert bag(got) == bag(want) and got.count() == 4


def test_a_new_day_reads_no_old_results(make, followed, monkeypatch):
    results, recent = followed
    monkeypatch.setattr(results, "read", lambda: pytest.fail("reads the results"))
    results.replace_date(some_results(make, random.Random(4), [day(60)]), day(60))
    assert recent.base() == date.fromisoformat(day(56))


def test_days_before_the_base_and_changes_by_others_are_refused(spark, make, followed):
    results, recent = followed
    with pytest.raises(ValueError, match="are kept for scoring"):
        recent.before(day(53))
    other = DatedTable(spark, results.path, ANOMALY_RESULTS)
    before = bag(other.read())
    fresh = some_results(make, random.Random(5), [day(58)])
    for change in (lambda: other.append(fresh), lambda: other.replace_date(fresh, day(58)), lambda: other.retain(day(60))):
        with pytest.raises(ValueError, match="is followed by"):
            change()
    assert bag(other.read()) == before


@pytest.mark.parametrize("first", ["results", "recent"])
def test_a_change_that_ends_half_way_reaches_both(spark, make, followed, monkeypatch, first):
    results, recent = followed
    with monkeypatch.context() as m:
        done, move = [], DatedTable._move

        def one_move(self, source, target):
            if done:
                raise KeyboardInterrupt
            done.append(target)
            move(self, source, target)

        m.setattr(DatedTable, "_move", one_move)
        with pytest.raises(KeyboardInterrupt):
            results.replace_date(some_results(make, random.Random(6), [day(60)]), day(60))
    results = DatedTable(spark, results.path, ANOMALY_RESULTS, RecentDays(spark, recent.table.path, spare=4))
    recent = results.recent
    (results if first == "results" else recent.table).recover()
    assert recent.base() == date.fromisoformat(day(56)) and recent.table.dates() == [recent.base()]
    assert_same_scores(spark, make, results, recent, [day(61)])


def test_empty_results(spark, make, tmp_path):
    results = DatedTable(spark, str(tmp_path / "results"), ANOMALY_RESULTS)
    recent = RecentDays(spark, str(tmp_path / "recent"))
    recent.start(results)
    assert recent.base() is None and recent.before(day(0)).count() == 0
    results.append(some_results(make, random.Random(7), [day(0), day(1)]))
    assert_same_scores(spark, make, results, recent, [day(2)])
    results.replace_range(results.read().limit(0), day(0), day(1))
    assert recent.base() is None and recent.before(day(2)).count() == 0


def test_misnamed_sites_by_day(spark, make, tmp_path):
    kept = MisnamedSites(spark, str(tmp_path / "misnamed"))
    assert kept.read().count() == 0
    names = ["S000001", "S000002", "S3", "S00004"]

    def counts(rows):
        return make.row_counts([(d, make.key(name, level=level), 1) for d, name, level in rows])

    old = [(day(n), names[n % 2], "site") for n in range(0, 70, 3)] + [(day(30), names[3], "site"), (day(5), names[2], "cell")]
    kept.feed(counts(old), "0001-01-01", "9999-12-31")
    today = make.row_counts([(day(80), make.key(n), 1) for n in (*names, None)])

    def assert_same(rows):
        assert bag(not_in_bad_sites(today, kept.read())) == bag(not_in_bad_sites(today, counts(rows)))

    assert_same(old)
    assert kept.table.read().count() == 6  # a row per month and name
    fresh = [(day(31), names[2], "site")]
    rest = [r for r in old if not day(29) <= r[0] <= day(35)]
    kept.feed(counts(old + fresh), day(70), day(75))  # nothing new there
    assert_same(old)
    kept.feed(counts(fresh), day(29), day(35))
    assert_same(rest + fresh)
    kept.feed(counts([]), "2024-01-01", day(200))
    assert_same([])
    assert kept.table.dates() == []
