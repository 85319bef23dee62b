from datetime import date, timedelta

import pytest

from kpiwarden.plans.detail import detail, detail_completeness, start_completeness

START = date(2024, 1, 1)


def day(i):
    return (START + timedelta(days=i)).isoformat()


def outcome(df, value="value"):
    return sorted(
        ((r["date"].isoformat(), r["location"], r[value], r["rata"], r["status"])
         for r in df.collect()),
        key=repr,
    )


def test_branches(make):
    old, new, gone, unknown = (make.key(f"S0000{i}") for i in range(1, 5))
    values = [98.0, 102.0, 99.0, 101.0, 100.0, 100.0, 100.0]
    history = [(day(i), old, v, "ok") for i, v in enumerate(values)]
    history += [(day(i), gone, 50.0, "ok") for i in range(3)]
    history += [(day(i), new, 10.0, "ok") for i in range(6)]
    source = [
        (day(10), old, 100.5), (day(10), old, 200.0), (day(10), old, None), (day(10), old, 0.0),
        (day(10), new, 77.0), (day(10), new, None),
    ]
    asked = [(day(10), k) for k in (old, old, new, gone, unknown, make.key("S00001", vendor=None))]
    got = detail(make.observations(source), make.results(history), make.requests(asked))
    assert outcome(got) == sorted(
        [
            (day(10), "S00001", 100.5, 100.0, "ok"),
            (day(10), "S00001", 200.0, 100.0, "anomaly"),
            (day(10), "S00001", None, 100.0, "anomaly"),
            (day(10), "S00001", 0.0, 100.0, "anomaly"),
            (day(10), "S00002", 77.0, None, "ok"),
            (day(10), "S00003", None, 50.0, "no data"),
        ],
        key=repr,
    )


def test_row_being_replaced_does_not_count(make):
    key = make.key("S00001")
    history = [(day(i), key, 100.0, "ok") for i in range(6)] + [(day(10), key, 100.0, "ok")]
    source = make.observations([(day(10), key, 500.0)])
    asked = make.requests([(day(10), key)])
    got = detail(source, make.results(history), asked)
    assert outcome(got) == [(day(10), "S00001", 500.0, None, "ok")]
    # Accepted rows on later dates do count.
    later = history + [(day(11), key, 100.0, "ok")]
    got = detail(source, make.results(later), asked)
    assert outcome(got) == [(day(10), "S00001", 500.0, 100.0, "anomaly")]


def test_several_dates_of_one_series(make):
    key = make.key("S00001")
    history = [(day(i), key, float(i), "ok") for i in range(20)]
    # Two different rows on day 15, and day 16 loaded twice.
    history += [(day(15), key, 30.0, "ok"), (day(16), key, 16.0, "ok")]
    asked = make.requests([(day(i), key) for i in (0, 3, 15, 16, 18, 40, 41)])
    got = detail(make.observations([]), make.results(history), asked)
    expected = {
        3: [0, 1, 2],
        15: range(8, 15),
        16: [15, 30, 14, 13, 12, 11, 10],
        18: [17, 16, 15, 30, 14, 13, 12],
        40: [19, 18, 17, 16, 15, 30, 14],
        41: [19, 18, 17, 16, 15, 30, 14],
    }
    means = {r["date"].isoformat(): r["rata"] for r in got.collect()}
    assert means == {
        day(d): pytest.approx(sum(values) / len(values)) for d, values in expected.items()
    }


def test_completeness_branches_and_start(make):
    key, new = make.key("S00001"), make.key("S00002")
    history = make.results([(day(i), key, 100, "ok") for i in range(7)], count=True)
    source = make.row_counts(
        [(day(10), key, n) for n in (95, 105, 106, 94, None)] + [(day(10), new, 3)]
    )
    asked = make.requests([(day(10), key), (day(10), new)])
    got = detail_completeness(source, history, asked)
    statuses = {(r["location"], r["row_count"]): r["status"] for r in got.collect()}
    assert statuses == {
        ("S00001", 95): "ok", ("S00001", 105): "ok", ("S00001", 106): "duplicated",
        ("S00001", 94): "not ok", ("S00001", None): "not ok", ("S00002", 3): "ok",
    }
    first = start_completeness(source, make.results([], count=True), day(10))
    assert [r["status"] for r in first.collect()] == ["ok"] * 5
