"""Replays equal a plain simulation, day by day."""

import random
from datetime import date, timedelta

import pytest

from kpiwarden.functions.rules import CLASS_RULES, PLAIN
from kpiwarden.plans import replay as replay_plan
from kpiwarden.plans.replay import replay

START = date(2024, 1, 1)


def simulate(rule, history, rows, first, last):
    accepted = [(d, k, v) for d, k, v, s in history if s == "ok" and d < first]
    out = []
    for n in range((last - first).days + 1):
        day = first + timedelta(days=n)
        fresh = []
        for d, key, value in (r for r in rows if r[0] == day):
            past = [
                (pd, pv) for pd, pk, pv in accepted
                if pk == key and pk[3] is not None
                and (not rule.by_weekday or pd.weekday() == day.weekday())
            ]
            top = [pv for pd, pv in past if 1 + sum(o[0] > pd for o in past) <= 7]
            mean = sum(top) / len(top) if top else None
            bad = (
                value is None or mean is None or value < 0
                or (rule.reject_zero and value == 0)
                or (rule.reject_over_100 and value > 100)
            )
            ok = not bad and mean * 0.9 <= value <= mean * 1.1
            out.append((day, key, value, mean, "ok" if ok else "anomaly"))
            if ok:
                fresh.append((day, key, value))
        accepted += fresh
    return out


def random_case(make, rule, seed, per_day=(0, 1, 1, 2, 4), step=1.0):
    rng = random.Random(seed)
    keys = [make.key(f"S{i:05d}", vendor=None if i == 0 else "V") for i in range(4)]
    history, rows = [], []
    for key in keys:
        level = rng.choice([50, 80])
        for n in range(90):
            day = START + timedelta(days=n)
            for _ in range(rng.choice(per_day)):
                value = level + rng.randint(-8, 8) * step
                value = rng.choice([value] * 20 + [None, 0.0, -3.0, 105.0])
                rows.append((day, key, value))
                if n < 40 or rng.random() < 0.1:
                    status = "ok" if value is not None and value > 0 else "anomaly"
                    history.append((day, key, value, status))
    return history, rows


@pytest.mark.parametrize("step", [1.0, 0.625, 0.1])
@pytest.mark.parametrize("rule", CLASS_RULES, ids=lambda r: r.name)
def test_replay_equals_simulation(make, rule, step):
    history, rows = random_case(make, rule, seed=len(rule.name), step=step)
    if step == 1.0:  # one series with most of the rows
        key = make.key("S00009")
        rows += [(START + timedelta(days=n), key, 50.0 + i % 11) for n in range(90) for i in range(60)]
        history += [(START + timedelta(days=n), key, 52.0, "ok") for n in range(50)]
    first, last = START + timedelta(days=60), START + timedelta(days=75)
    expected = simulate(rule, history, rows, first, last)
    tables = (
        make.observations([(d.isoformat(), k, v) for d, k, v in rows]),
        make.results([(d.isoformat(), k, v, s) for d, k, v, s in history]),
        make.kpi_list(rule),
        make.sites(),
    )
    options = dict(category="ran", rule=rule, start=first.isoformat(), end=last.isoformat())

    def bag(items):
        return sorted(
            repr((d, k, v, m if m is None else round(m, 9), s)) for d, k, v, m, s in items
        )

    def collected(df):
        return bag(
            (r["date"], make.key(r["location"], vendor=r["vendor"]), r["value"], r["rata"],
             r["status"])
            for r in df.collect()
        )

    want = bag(expected)
    assert any("'ok'" in w for w in want)
    assert collected(replay(*tables, **options)) == want
    assert collected(replay(*tables, **options, look_back=20)) == want


def test_repeats_that_cancel_do_not_end_a_replay(make):
    """A round that accepts {a, a} and one that accepts {b, b} are not the same."""
    key = make.key("S00001")
    days = [
        [(100.0, 7), (300.0, 7)],
        [(200.0, 8), (100.0, 8)],
        [(150.0, 8), (200.0, 8), (100.0, 8)],
        [(100.0, 8), (200.0, 8), (150.0, 8)],
    ]
    history = [(START, key, 100.0, "ok")] * 7
    rows = [(START + timedelta(days=n + 1), key, v) for n, day in enumerate(days) for v, times in day for _ in range(times)]
    first, last = START + timedelta(days=1), START + timedelta(days=4)
    out = replay(
        make.observations([(d.isoformat(), k, v) for d, k, v in rows]),
        make.results([(d.isoformat(), k, v, s) for d, k, v, s in history]),
        make.kpi_list(PLAIN), make.sites(),
        category="ran", rule=PLAIN, start=first.isoformat(), end=last.isoformat(),
    )
    got = sorted((r["date"], r["value"], r["rata"], r["status"]) for r in out.collect())
    assert got == sorted((d, v, m, s) for d, _, v, m, s in simulate(PLAIN, history, rows, first, last))


def test_rounds_look_at_fewer_days(spark, make, monkeypatch):
    """Only what lies beyond a series' first changed day is judged again, and each day is settled once."""
    seen = []

    def rounds(rows, prior, by, rule):
        for days in found(rows, prior, by, rule):
            seen.append(days)
            yield days

    found = replay_plan._rounds
    monkeypatch.setattr(replay_plan, "_rounds", rounds)
    history, rows = random_case(make, PLAIN, seed=12)
    first, last = START + timedelta(days=60), START + timedelta(days=85)
    # a level that rises step by step, each step within the band of the one before
    key = make.key("S00020")
    history += [(START + timedelta(days=50 + n), key, 100.0, "ok") for n in range(7)]
    rows += [(START + timedelta(days=60 + n), key, 100.0 * 1.06 ** n) for n in range(26)]
    out = replay(
        make.observations([(d.isoformat(), k, v) for d, k, v in rows]),
        make.results([(d.isoformat(), k, v, s) for d, k, v, s in history]),
        make.kpi_list(PLAIN), make.sites(),
        category="ran", rule=PLAIN, start=first.isoformat(), end=last.isoformat(),
    )
    got = sorted((r["date"], r["location"], r["value"] or 0, r["status"]) for r in out.collect())
    assert got == sorted((d, k[5], v or 0, s) for d, k, v, _, s in simulate(PLAIN, history, rows, first, last))
    counts = [d.count() for d in seen]
    assert len(counts) > 2 and all(a > b for a, b in zip(counts, counts[1:]))
    settled = [(r["series"], r["date"]) for d in seen for r in d.where("settled").select("series", "date").collect()]
    assert len(settled) == len(set(settled)) == counts[0]
