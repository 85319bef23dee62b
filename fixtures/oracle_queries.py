"""The queries of ``queries.py`` in SQL, written from the rules' definitions."""

from __future__ import annotations

from datetime import date, timedelta

from fixtures.derived import CATEGORY, CUT_OFF, DAY, KEEP_AS_OF, REPLAY_END, REPLAY_START
from fixtures.oracle import KEYS, with_views

_ON = " and ".join(f"{{a}}.{k} = {{b}}.{k}" for k in KEYS.split(", "))
_FILLED = " and ".join(
    f"{k} is not null" for k in ("kpi", "granularity", "node", "level", "location")
)
_BAD = "select location from bad_sites"
_BAD_COUNTS = "select location from bad_counts"

# name: (rate_status, trend, values rejected before the band is looked at, values seeded)
_CLASSES = {
    "plain": ("N", "F", "value is null or value <= 0", "value > 0"),
    "trend": ("N", "T", "value is null or value < 0", "value > 0"),
    "rate": ("Y", "F", "value is null or value < 0 or value > 100", "value between 0 and 100"),
    "rate_trend": (
        "Y", "T", "value is null or value < 0 or value > 100", "value between 0 and 100"
    ),
}


def _on(a: str, b: str) -> str:
    return _ON.format(a=a, b=b)


def _round(*columns: str) -> str:
    return ", ".join(
        f"floor({c} * 10000 + 0.5) / 10000 as {c.split('.')[-1]}" for c in columns
    )


_BOUNDS = _round("b_atas", "b_bawah", "rata")


def _kpis(name: str) -> str:
    rate, trend = _CLASSES[name][:2]
    return (
        f"select kpi from kpi_list where status = 'include' and rate_status = '{rate}' "
        f"and trend = '{trend}' and category = '{CATEGORY}'"
    )


def _anomaly_status(rejected: str) -> str:
    return (
        f"case when {rejected} then 'anomaly' "
        "when value >= b_bawah and value <= b_atas then 'ok' else 'anomaly' end"
    )


def _count_status() -> str:
    return (
        "case when row_count >= b_bawah and row_count <= b_atas then 'ok' "
        "when row_count > b_atas then 'duplicated' else 'not ok' end"
    )


def _band(source: str, value: str, low: float, high: float, by: str = KEYS) -> str:
    """Band per series over the seven best ranked rows of ``source``."""
    return f"""select {by}, avg({value}) as rata,
    avg({value}) * cast({high} as double) as b_atas,
    avg({value}) * cast({low} as double) as b_bawah
  from (select *, rank() over (partition by {by} order by date desc) as r from {source})
  where r <= 7 group by {by}"""


def _sigma_band(source: str, by: str = KEYS) -> str:
    return f"""select {by}, avg(value) as rata,
    case when stddev_samp(value) = 0 then cast(1.05 as double) * avg(value)
      else avg(value) + 3 * stddev_samp(value) end as b_atas,
    case when stddev_samp(value) = 0 then cast(0.95 as double) * avg(value)
      else avg(value) - 3 * stddev_samp(value) end as b_bawah
  from (select *, rank() over (partition by {by} order by date desc) as r from {source})
  where r <= 7 group by {by}"""


# What the classes differ in: is zero rejected, and above which value is one rejected?
_MATRIX = """(values ('N', 'F', true, 'infinity'::double), ('N', 'T', false, 'infinity'::double),
    ('Y', 'F', false, 100.0::double), ('Y', 'T', false, 100.0::double)
  ) matrix(rate_status, trend, zero_is_bad, greatest_value)"""

# The scored day of all four classes.
_SCORED = {
    "scored_kpis": f"""select distinct kpi, rate_status, trend, zero_is_bad, greatest_value
  from kpi_list join {_MATRIX} using (rate_status, trend)
  where status = 'include' and category = '{CATEGORY}'""",
    "recent_mean": f"""select kpi, rate_status, trend, granularity, node, vendor, level, location, avg(value) as rata
  from (
    select * exclude (rata) from results join scored_kpis using (kpi)
    where status = 'ok' and date < date '{DAY}'
      and (trend = 'F' or dayname(date) = dayname(date '{DAY}'))
    qualify rank() over (partition by rate_status, trend, {KEYS} order by date desc) <= 7)
  group by all""",
    "scored": f"""select date, {KEYS}, value, rata * 1.1::double as b_atas, rata * 0.90::double as b_bawah, rata,
    if(value between rata * 0.90::double and rata * 1.1::double
      and value >= 0 and value <= greatest_value and not (zero_is_bad and value = 0), 'ok', 'anomaly') as status,
    rate_status, trend
  from observations join scored_kpis using (kpi)
  left join recent_mean using (rate_status, trend, {KEYS})
  where date = date '{DAY}' and {_FILLED} and location not in ({_BAD})""",
}

_COUNTED_DAY = {
    "recent_count": f"""select {KEYS}, avg(row_count) as rata
  from (select * exclude (rata) from completeness_results where status = 'ok' and date < date '{DAY}'
    qualify rank() over (partition by {KEYS} order by date desc) <= 7)
  group by all""",
    "scored_counts": f"""select *, case
      when row_count > b_atas then 'duplicated' when row_count >= b_bawah then 'ok' else 'not ok' end as status
  from (
    select date, {KEYS}, row_count, rata * 1.08::double as b_atas, rata * 0.92::double as b_bawah, rata
    from row_counts left join recent_count using ({KEYS})
    where date = date '{DAY}' and location not in ({_BAD_COUNTS}))""",
}


def _class(name: str) -> str:
    rate, trend = _CLASSES[name][:2]
    return f"(select * from scored where rate_status = '{rate}' and trend = '{trend}')"


def _score(name: str) -> str:
    extra = ", dayname(date) as day_name" if name.endswith("trend") else ""
    return with_views(
        f"select date, {KEYS}, value, {_BOUNDS}, status{extra} from {_class(name)}", **_SCORED
    )


def _seeded(name: str) -> str:
    by = KEYS + (", dayname(date)" if name.endswith("trend") else "")
    return f"""select date, {KEYS}, value, 'ok' as status from (
    select *, rank() over (partition by {by} order by date desc) as r from observations
    where date <= date '{CUT_OFF}' and {_CLASSES[name][3]} and kpi in ({_kpis(name)})
      and location not in ({_BAD}) and {_FILLED})
  where r <= 10"""


def _counted(source: str, by: str, value: str = "value") -> str:
    return (
        f"select {by}, count(*) as n, cast(sum({value}) as double) as total "
        f"from ({source}) group by {by}"
    )


def _detail_views(source: str, results: str, value: str, asked: str = "requests") -> dict[str, str]:
    by = f"asked, {KEYS}"
    past = f"""(select q.date as asked, d.* from asked_for q join accepted d
      on {_on("q", "d")} and d.date < q.date)"""
    if value == "value":
        band, status = _sigma_band(past, by), _anomaly_status("value is null or value = 0")
    else:
        band, status = _band(past, "row_count", 0.95, 1.05, by), _count_status()
    columns = f"date, {KEYS}, {value}, b_bawah, rata, b_atas, status"
    keys = ", ".join(f"q.{k}" for k in KEYS.split(", "))
    return {
        "asked_for": f"select distinct date, {KEYS} from {asked}",
        "accepted": f"select distinct {columns} from {results} where status = 'ok'",
        "band": band,
        "asked": f"""select q.*, b.b_atas, b.b_bawah, b.rata, b.asked is not null as has_band,
    exists(select 1 from {source} s where s.date = q.date and {_on("s", "q")}) as present,
    coalesce(c.n, 0) - coalesce(t.n, 0) as jml
  from asked_for q
  left join band b on b.asked = q.date and {_on("b", "q")}
  left join (select {KEYS}, count(*) as n from {results} where status = 'ok' group by all) c
    on {_on("c", "q")}
  left join (select date, {KEYS}, count(*) as n from {results} where status = 'ok'
    group by all) t on t.date = q.date and {_on("t", "q")}""",
        "outcome": f"""select q.date, {keys}, {value}, b_atas, b_bawah, rata, {status} as status
  from asked q join {source} s on s.date = q.date and {_on("s", "q")} where jml >= 7
  union all
  select q.date, {keys}, {value}, null, null, null, 'ok'
  from asked q join {source} s on s.date = q.date and {_on("s", "q")}
  where jml < 7 and {value} is not null
  union all
  select date, {KEYS}, null, b_atas, b_bawah, rata, 'no data'
  from asked where not present and has_band""",
    }


_ANOMALY_DETAIL = _detail_views("observations", "results", "value")
_COUNT_DETAIL = _detail_views("row_counts", "completeness_results", "row_count")


def _detail(value: str, views: dict[str, str], where: str = "true") -> str:
    return with_views(
        f"select date, {KEYS}, {value}, {_BOUNDS}, status from outcome where {where}", **views
    )


def _replay_views(name: str) -> dict[str, str]:
    """One common table expression per day, each seeing the accepted rows of those before."""
    rejected = _CLASSES[name][2]
    day, end = date.fromisoformat(REPLAY_START), date.fromisoformat(REPLAY_END)
    by = KEYS + (", dayname(date)" if name.endswith("trend") else "")
    views = {
        "accepted_0": f"""select date, {KEYS}, value from (
    select *, rank() over (partition by {by} order by date desc) as r from results
    where status = 'ok' and date < date '{REPLAY_START}' and kpi in ({_kpis(name)})
      and location not in ({_BAD}) and {_FILLED}) where r <= 7""",
        "in_range": f"""select * from observations
  where date between date '{REPLAY_START}' and date '{REPLAY_END}' and kpi in ({_kpis(name)})
    and location not in ({_BAD}) and {_FILLED}""",
    }
    step = 0
    while day <= end:
        step += 1
        past = f"(select * from accepted_{step - 1} where true"
        if name.endswith("trend"):
            past += f" and dayname(date) = dayname(date '{day}')"
        views[f"day_{step}"] = f"""
  select date, {KEYS}, value, b_atas, b_bawah, rata, {_anomaly_status(rejected)} as status
  from in_range left join ({_band(past + ")", "value", 0.90, 1.1)}) using ({KEYS})
  where date = date '{day}'"""
        views[f"accepted_{step}"] = f"""select * from accepted_{step - 1} union all
  select date, {KEYS}, value from day_{step} where status = 'ok'"""
        day += timedelta(days=1)
    every = " union all ".join(f"select * from day_{i}" for i in range(1, step + 1))
    return views | {"replayed": every}


def _replay(name: str) -> str:
    return with_views(
        f"select date, {KEYS}, value, {_BOUNDS}, status from replayed", **_replay_views(name)
    )


def _stored_replay() -> str:
    within = f"date between date '{REPLAY_START}' and date '{REPLAY_END}' and kpi in ({_kpis('plain')})"
    parts = []
    for stored, which in (("results", "true"), ("history", "status = 'anomaly'")):
        parts += [
            f"select '{stored}' as stored, date, kpi, status, value from results where not ({within}) and {which}",
            f"select '{stored}', date, kpi, status, value from replayed where {which}",
        ]
    return with_views(_counted(" union all ".join(parts), "stored, date, kpi, status"), **_replay_views("plain"))


def _classified(value: str, status: str, low: float, high: float, kpis: str = "") -> str:
    """Every stored row judged against the rule's band around its own mean; clusters have no lower bound."""
    table = "results" if value == "value" else "completeness_results"
    table += f" where kpi in ({kpis})" if kpis else ""
    return _counted(
        f"""select kpi, level, {value}, {status} as status from (
      select kpi, level, {value}, middle * {high}::double as b_atas,
        case when level <> 'cluster' then middle * {low}::double end as b_bawah
      from (select *, case when {value} % 3 = 0 then 120 else rata end as middle from {table}))""",
        "kpi, level, status", value,
    )


def _accepted(table: str, extra: str = "", distinct: bool = False) -> str:
    what = "distinct *" if distinct else "*"
    return f"(select {what}{extra} from {table} where status = 'ok' and date < date '{DAY}')"


def _bands(band: str, by: str = KEYS) -> str:
    return with_views(f"select {by}, {_BOUNDS} from ({band})")


def oracle_sql() -> dict[str, str]:
    weekday_keys = f"{KEYS}, day_name"
    kept_of_results = f"""select date, kpi, status, value from results
    where not (date = date '{DAY}' and kpi in ({_kpis("plain")}))"""
    sql = {
        "kpi_select": with_views(
            " union all ".join(f"select kpi, '{c}' as class from ({_kpis(c)})" for c in _CLASSES)
        ),
        "bad_site_locations": with_views(f"select distinct location from ({_BAD})"),
        "observations_clean": with_views(
            _counted(f"select * from observations where {_FILLED}", "kpi, vendor, level, location")
        ),
        "kpi_semi_join": with_views(
            _counted(f"select * from observations where kpi in ({_kpis('plain')})", "kpi, location")
        ),
        "site_anti_join": with_views(
            _counted(
                f"select * from observations where {_FILLED} and location not in ({_BAD})",
                "kpi, level, location",
            )
        ),
        "site_not_in": with_views(
            _counted(
                f"select * from row_counts where location not in ({_BAD_COUNTS})",
                "kpi, level, location", "row_count",
            )
        ),
        "weekday_name": with_views(
            "select distinct date, dayname(date) as day_name, date + 1 as next_date "
            "from observations"
        ),
        "weekday_padded": with_views(
            _counted("select dayname(date) as day_name, * from observations", "day_name, kpi")
        ),
        "replay_dates": with_views(
            f"""select {KEYS}, cast(unnest(generate_series(
              last_date, date '{DAY}', interval 1 day)) as date) as date
            from (select {KEYS}, max(date) as last_date from results
              where status = 'ok' and date < date '{DAY}' group by all)"""
        ),
        "recent_rank": with_views(
            f"""select date, {KEYS}, value, r as rank from (select *,
              rank() over (partition by {KEYS} order by date desc) as r
              from results where status = 'ok' and {_FILLED}) where r <= 7"""
        ),
        "recent_rank_weekday": with_views(
            f"""select date, {weekday_keys}, value, r as rank from (select *,
              rank() over (partition by {weekday_keys} order by date desc) as r
              from (select *, dayname(date) as day_name from results)
              where status = 'ok' and {_FILLED}) where r <= 7"""
        ),
        "baseline_band": _bands(_band(_accepted("results"), "value", 0.90, 1.1)),
        "baseline_band_weekday": _bands(
            _band(
                _accepted("results", ", dayname(date) as day_name"),
                "value", 0.90, 1.1, weekday_keys,
            ),
            weekday_keys,
        ),
        "baseline_rowcount": _bands(
            _band(_accepted("completeness_results"), "row_count", 0.92, 1.08)
        ),
        "baseline_sigma": _bands(_sigma_band(_accepted("results", distinct=True))),
        "baseline_rowcount_detail": _bands(
            _band(_accepted("completeness_results", distinct=True), "row_count", 0.95, 1.05)
        ),
        "ok_counts": with_views(
            f"select {KEYS}, count(*) as jml from results where status = 'ok' group by all"
        ),
        "series_exists": with_views(
            f"""select *, cast(exists(select 1 from observations s
              where s.date = q.date and {_on("s", "q")}) as integer) as hasil
            from requests q"""
        ),
        "score_all": with_views(
            f"select date, {KEYS}, value, {_BOUNDS}, status, rate_status, trend from scored", **_SCORED
        ),
        "history_anomaly": with_views(
            f"select date, {KEYS}, value, {_BOUNDS}, status from {_class('plain')} where status = 'anomaly'",
            **_SCORED,
        ),
        "completeness_score": with_views(
            f"select date, {KEYS}, row_count, {_BOUNDS}, status from scored_counts", **_COUNTED_DAY
        ),
        "history_completeness": with_views(
            f"select date, {KEYS}, row_count, {_BOUNDS}, status from scored_counts where status = 'not ok'",
            **_COUNTED_DAY,
        ),
        "detail_anomaly": _detail("value", _ANOMALY_DETAIL),
        "detail_init": _detail("value", _ANOMALY_DETAIL, "status = 'ok' and rata is null"),
        "detail_no_data": _detail("value", _ANOMALY_DETAIL, "status = 'no data'"),
        "detail_completeness": _detail("row_count", _COUNT_DETAIL),
        "completeness_start": _detail(
            "row_count",
            _detail_views(
                "row_counts", "completeness_results", "row_count",
                f"row_counts where date = date '{DAY}'",
            ),
        ),
        "replace_slice": with_views(
            _counted(
                f"{kept_of_results} union all "
                f"select date, kpi, status, value from {_class('plain')}",
                "date, kpi, status",
            ),
            **_SCORED,
        ),
        "reseed_class": with_views(
            _counted(
                f"""select date, kpi, status, value from results
                  where kpi not in ({_kpis("plain")})
                union all select date, kpi, status, value from ({_seeded("plain")})""",
                "date, kpi, status",
            )
        ),
        "replace_date": with_views(
            _counted(
                f"""select date, kpi, status, row_count from completeness_results
                  where date <> date '{DAY}'
                union all select date, kpi, status, row_count from scored_counts""",
                "date, kpi, status", "row_count",
            ),
            **_COUNTED_DAY,
        ),
        "replace_series": with_views(
            _counted(
                f"""select date, kpi, status, value from results r
                  where not exists (select 1 from asked_for q
                    where q.date = r.date and {_on("q", "r")})
                union all select date, kpi, status, value from outcome""",
                "date, kpi, status",
            ),
            **_ANOMALY_DETAIL,
        ),
        "retention_history": with_views(
            f"""select date, kpi, status, count(*) as n from (
              select date, kpi, status from results where status = 'anomaly'
              union all
              select date, kpi, status from completeness_results where status = 'not ok')
            where date > date '{KEEP_AS_OF}' - 31 group by all"""
        ),
        "classify_sigma": with_views(
            _classified("value", _anomaly_status("value is null or value = 0"), 0.95, 1.05)
        ),
        "classify_completeness": with_views(_classified("row_count", _count_status(), 0.92, 1.08)),
        "classify_completeness_detail": with_views(_classified("row_count", _count_status(), 0.95, 1.05)),
    }
    for plain, others in {
        "score_all": ("score_all_look_back", "stored_recent_score"),
        "completeness_score": ("completeness_look_back", "stored_recent_completeness"),
        "replace_slice": ("stored_slice",),
        "reseed_class": ("stored_reseed",),
        "replace_date": ("stored_date",),
        "replace_series": ("stored_series",),
    }.items():
        sql |= {name: sql[plain] for name in others}
    sql["seed_look_back"] = with_views(_seeded("plain"))
    sql["stored_append"] = with_views(_counted("select * from results", "date, kpi, status"))
    sql["stored_replay"] = _stored_replay()
    sql["stored_histories"] = with_views(
        _counted(
            f"""select category, date, kpi, value from results
            cross join (values ('core'), ('{CATEGORY}')) c(category)
            where status = 'anomaly' and date > date '{KEEP_AS_OF}' - 31
              and (category <> 'core' or kpi like 'disc%')""",
            "category, date, kpi",
        )
    )
    for name in _CLASSES:
        sql[f"seed_{name}"] = with_views(_seeded(name))
        sql[f"score_{name}"] = _score(name)
        sql[f"replay_{name}"] = _replay(name)
        sql[f"classify_{name}"] = with_views(
            _classified("value", _anomaly_status(_CLASSES[name][2]), 0.90, 1.1, _kpis(name))
        )
    return sql
