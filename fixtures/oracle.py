"""The tables of ``derived.py`` as SQL views for the comparison engine."""

from __future__ import annotations

from fixtures.derived import CATEGORY, DAY, LATER_DAY, NEW_SITE_FROM

KEYS = "kpi, granularity, node, vendor, level, location"

_LEVEL = "case when {s} % 20 = 11 then 'cluster' else 'site' end"
_LOCATION = """case {s} % 20
    when 10 then 'S' || lpad(cast({s} as varchar), 6, '0')
    when 11 then 'S' || lpad(cast({s} - 1 as varchar), 6, '0')
    when 12 then null
    else 'S' || lpad(cast({s} as varchar), 5, '0') end"""

_PER_METRIC = """
  select d, s, m.metric || '_' || lower(f) as kpi, m.metric, 100 + q as row_count,
    cast(case m.metric
      when 'qty' then 100 + floor(q / n)
      when 'price' then 1000 + floor(p / (n * 100))
      when 'disc' then 30 + 2 * floor(dc / n)
      when 'line' then 60 + 5 * floor(ln / n)
      else floor(q / n) end as double) as value
  from {source} cross join (values ('qty'), ('price'), ('disc'), ('line'), ('tax')) m(metric)
"""

VIEWS = {
    "base": """
  select cast(l_shipdate as date) as d, l_suppkey as s, l_returnflag as f,
    count(*) as n,
    cast(sum(cast(l_quantity as bigint)) as bigint) as q,
    cast(sum(floor(l_extendedprice)) as bigint) as p,
    cast(sum(cast(round(l_discount * 100) as bigint)) as bigint) as dc,
    cast(sum(l_linenumber) as bigint) as ln
  from lineitem group by all""",
    "site_rows": f"""
  select d as date, s, metric, kpi,
    case when s % 20 <> 13 then 'daily' end as granularity,
    case when s % 20 <> 14 then 'ran' end as node,
    case when s % 20 <> 3 then 'V' || cast(s % 3 as varchar) end as vendor,
    {_LEVEL.format(s="s")} as level,
    {_LOCATION.format(s="s")} as location,
    case s % 20 when 0 then 0.0 when 1 then -5.0 when 2 then null
      when 5 then 120.0 when 6 then 77.0 else value end as value,
    case when s % 20 <> 2 then row_count end as row_count
  from ({_PER_METRIC.format(source="base")})""",
    "raw": f"""
  select * from site_rows
  union all
  select * replace (value + 1 as value, row_count + 1 as row_count)
  from site_rows where s % 20 = 4 and day(date) % 3 = 0
  union all
  select d, s, metric, kpi, 'daily', 'ran', 'ALL', 'national', 'ALL', value, row_count
  from ({_PER_METRIC.format(source='''(
    select d, -1 as s, f, cast(sum(n) as bigint) as n, cast(sum(q) as bigint) as q,
      cast(sum(p) as bigint) as p, cast(sum(dc) as bigint) as dc, cast(sum(ln) as bigint) as ln
    from base group by d, f)''')})""",
    "observations": f"select date, {KEYS}, value from raw",
    "row_counts": f"select date, {KEYS}, row_count from raw",
    "loaded": "select * from raw union all select * from raw where s % 20 = 7",
    "results": f"""
  select date, {KEYS}, value, value + 10 as b_atas, value - 10 as b_bawah, value as rata,
    case when value > 0 and row_count % 7 <> 2
      and (metric not in ('disc', 'line') or value <= 100)
      and (s % 20 <> 8 or date >= date '{NEW_SITE_FROM}') then 'ok' else 'anomaly' end as status
  from loaded""",
    "completeness_results": f"""
  select date, {KEYS}, row_count, cast(row_count + 10 as double) as b_atas,
    cast(row_count - 10 as double) as b_bawah, cast(row_count as double) as rata,
    case when row_count % 7 <> 2
      and (s % 20 <> 8 or date >= date '{NEW_SITE_FROM}') then 'ok' else 'not ok' end as status
  from loaded""",
    "site_master": f"""
  select {_LEVEL.format(s="s_suppkey")} as level, {_LOCATION.format(s="s_suppkey")} as location
  from supplier""",
    "kpi_list": f"""
  select m.metric || '_' || f as kpi, m.status, m.rate_status, m.trend, m.category
  from (select distinct lower(l_returnflag) as f from lineitem)
  cross join (values
    ('qty', 'N', 'F', 'include', '{CATEGORY}'), ('price', 'N', 'T', 'include', '{CATEGORY}'),
    ('disc', 'Y', 'F', 'include', '{CATEGORY}'), ('line', 'Y', 'T', 'include', '{CATEGORY}'),
    ('tax', 'N', 'F', 'exclude', '{CATEGORY}'), ('disc', 'N', 'F', 'include', 'core')
  ) m(metric, rate_status, trend, status, category)""",
    "bad_sites": "select distinct location from site_master where level = 'site' and length(location) <> 6",
    "bad_counts": "select distinct location from row_counts where level = 'site' and length(location) <> 6",
    "requests": f"""
  select dd.date, {KEYS} from (select distinct {KEYS} from observations)
  cross join (values (date '{DAY}'), (date '{LATER_DAY}')) dd(date)""",
}


def with_views(query: str, **extra: str) -> str:
    """The query with all fixture views, and any extra ones, in front.

    Each is computed once; left to inline them, the engine can take minutes under a row limit.
    """
    ctes = {**VIEWS, **extra}
    return "with " + ",\n".join(f"{n} as materialized ({sql})" for n, sql in ctes.items()) + "\n" + query
