"""Every operator and pipeline as a query over the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures import derived
from fixtures.derived import (
    CATEGORY, CUT_OFF, DAY, FOLLOWED_FROM, KEEP_AS_OF, LATER_DAY, REPLAY_END, REPLAY_START,
)
from kpiwarden.functions.dates import as_date, days_after, each_day, weekday_name, with_day_name
from kpiwarden.functions.rules import (
    CLASS_RULES,
    COMPLETENESS,
    COMPLETENESS_DETAIL,
    NO_DATA,
    OK,
    PLAIN,
    SCORE_DEPTH,
    SIGMA,
    Rule,
)
from kpiwarden.operators.bands import series_bands
from kpiwarden.operators.judge import status_of
from kpiwarden.operators.recent import accepted_counts, recent_rows, recent_totals
from kpiwarden.operators.selection import (
    bad_site_locations,
    kpi_select,
    not_in_bad_sites,
    of_kpis,
    outside_bad_sites,
    with_complete_keys,
)
from kpiwarden.operators.slices import in_slices, slices
from kpiwarden.plans import maintain
from kpiwarden.plans.detail import (
    detail,
    detail_completeness,
    series_exists,
    start_completeness,
)
from kpiwarden.plans.replay import replay
from kpiwarden.plans.score import (
    accepted_before,
    alerts,
    score,
    score_all,
    score_completeness,
)
from kpiwarden.plans.seed import seed
from kpiwarden.sources.schema import BOUNDS, KEYS
from kpiwarden.sources.kept import MisnamedSites, RecentDays
from kpiwarden.sources.scratch import scratch_path
from kpiwarden.sources.store import DatedTable, publish_range, retain_histories

LOOK_BACK = 60
WITH_WEEKDAY = (*KEYS, "day_name")


def rounded(df: DataFrame) -> DataFrame:
    """Bounds to four decimals, by the same arithmetic as the SQL."""
    return df.withColumns({b: F.floor(F.col(b) * 10000 + 0.5) / 10000 for b in BOUNDS})


def counted(df: DataFrame, *by: str, value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("double")).alias("total")
    )


class Tables:
    """The derived tables of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, by_date: bool = False):
        self.spark, self.sf_dir = spark, sf_dir
        dated = ("observations", "row_counts", "results", "completeness_results")
        self._make = lambda name: getattr(derived, name)(
            spark, sf_dir, *([True] if by_date and name in dated else [])
        )

    def __getattr__(self, name: str) -> DataFrame:
        return self._make(name)

    @property
    def scoring(self) -> tuple[DataFrame, ...]:
        return self.observations, self.results, self.kpi_list, self.site_master


def _by_date(t: Tables) -> Tables:
    return Tables(t.spark, t.sf_dir, by_date=True)


def _seed(t: Tables, rule: Rule, look_back: int | None = None) -> DataFrame:
    return seed(
        t.observations, t.kpi_list, t.site_master,
        category=CATEGORY, rule=rule, up_to=CUT_OFF, look_back=look_back,
    )


def _score(t: Tables, rule: Rule) -> DataFrame:
    return rounded(score(*t.scoring, category=CATEGORY, rule=rule, day=DAY))


def _score_all(t: Tables, look_back: int | None = None) -> DataFrame:
    return rounded(score_all(*t.scoring, category=CATEGORY, day=DAY, look_back=look_back))


def _completeness(t: Tables, look_back: int | None = None) -> DataFrame:
    return rounded(
        score_completeness(t.row_counts, t.completeness_results, day=DAY, look_back=look_back)
    )


def _replay(t: Tables, rule: Rule) -> DataFrame:
    return rounded(
        replay(*t.scoring, category=CATEGORY, rule=rule, start=REPLAY_START, end=REPLAY_END)
    )


def _detail(t: Tables) -> DataFrame:
    return rounded(detail(t.observations, t.results, t.requests))


def _detail_completeness(t: Tables) -> DataFrame:
    return rounded(detail_completeness(t.row_counts, t.completeness_results, t.requests))


def _kpi_select(t: Tables) -> DataFrame:
    parts = [
        kpi_select(t.kpi_list, CATEGORY, rule).withColumn("class", F.lit(rule.name))
        for rule in CLASS_RULES
    ]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def _plain_kpis(t: Tables) -> DataFrame:
    return kpi_select(t.kpi_list, CATEGORY, PLAIN)


def _band(t: Tables, rule: Rule, by: tuple[str, ...] = KEYS) -> DataFrame:
    results = t.results if rule.value == "value" else t.completeness_results
    history = accepted_before(results, DAY)
    if "day_name" in by:
        history = with_day_name(history)

    def bands(rows: DataFrame) -> DataFrame:
        return series_bands(recent_totals(rows, rule.value, rule.depth, by), rule)

    if rule is SIGMA or rule is COMPLETENESS_DETAIL:
        return rounded(in_slices(history, by, lambda of: bands(of(history).distinct()), "bands"))
    return rounded(bands(history))


def _recent(t: Tables, by: tuple[str, ...]) -> DataFrame:
    rows = with_complete_keys(t.results.where(F.col("status") == OK))
    if "day_name" in by:
        rows = with_day_name(rows)
    return recent_rows(rows, "value", SCORE_DEPTH, by).select("date", *by, "value", "rank")


def _classify(t: Tables, rule: Rule) -> DataFrame:
    """Every stored row judged against the rule's band around its own mean; clusters have no lower bound."""
    rows = t.results if rule.value == "value" else t.completeness_results
    if rule in CLASS_RULES:
        rows = of_kpis(rows, kpi_select(t.kpi_list, CATEGORY, rule))
    lower, upper = rule.band(F.when(F.col(rule.value) % 3 == 0, 120.0).otherwise(F.col("rata")))
    banded = rows.withColumns({"b_atas": upper, "b_bawah": F.when(F.col("level") != "cluster", lower)})
    return counted(
        banded.select("kpi", "level", rule.value, status_of(rule).alias("status")),
        "kpi", "level", "status", value=rule.value,
    )


def _padded_weekday(t: Tables) -> DataFrame:
    padded = t.observations.withColumn("day_name", F.rpad(weekday_name("date"), 9, " "))
    return counted(with_day_name(padded), "day_name", "kpi")


def _weekday_name(t: Tables) -> DataFrame:
    days = t.observations.select("date").distinct()
    return days.select(
        "date", weekday_name("date").alias("day_name"), days_after("date", 1).alias("next_date")
    )


def _replay_dates(t: Tables) -> DataFrame:
    last = accepted_before(t.results, DAY).groupBy(*KEYS).agg(F.max("date").alias("last_date"))
    return last.select(*KEYS, F.explode(each_day(F.col("last_date"), as_date(DAY))).alias("date"))


def _replaced(df: DataFrame, value: str = "value") -> DataFrame:
    return counted(df, "date", "kpi", "status", value=value)


def _replace_slice(t: Tables) -> DataFrame:
    fresh = score(*t.scoring, category=CATEGORY, rule=PLAIN, day=DAY)
    return _replaced(maintain.replace_slice(t.results, fresh, _plain_kpis(t), DAY))


def _reseed(t: Tables) -> DataFrame:
    return _replaced(maintain.reseed_class(t.results, _seed(t, PLAIN), _plain_kpis(t)))


def _replace_date(t: Tables) -> DataFrame:
    fresh = score_completeness(t.row_counts, t.completeness_results, day=DAY)
    return _replaced(maintain.replace_date(t.completeness_results, fresh, DAY), "row_count")


def _replace_series(t: Tables) -> DataFrame:
    fresh = detail(t.observations, t.results, t.requests)
    return _replaced(maintain.replace_series(t.results, fresh, t.requests))


def _stored_table(t: Tables, rows: DataFrame, name: str = "table") -> DatedTable:
    """The rows as a stored table, large ones in slices of dates.

    Its thousands of small folders are listed by few tasks, not by one task each.
    """
    t.spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", "16")
    table = DatedTable(t.spark, scratch_path(t.spark, name), rows.schema)
    for of in slices(rows, ["date"]):
        table.append(of(rows))
    return table


def _stored_slice(t: Tables) -> DataFrame:
    table = _stored_table(t, t.results)
    fresh = score(t.observations, table.read(), t.kpi_list, t.site_master, category=CATEGORY, rule=PLAIN, day=DAY)
    table.replace_slice(fresh, _plain_kpis(t), DAY)
    return _replaced(table.read())


def _stored_reseed(t: Tables) -> DataFrame:
    table = _stored_table(t, t.results)
    table.reseed(_seed(t, PLAIN), _plain_kpis(t))
    return _replaced(table.read())


def _stored_date(t: Tables) -> DataFrame:
    table = _stored_table(t, t.completeness_results)
    table.replace_date(score_completeness(t.row_counts, table.read(), day=DAY), DAY)
    return _replaced(table.read(), "row_count")


def _stored_series(t: Tables) -> DataFrame:
    table = _stored_table(t, t.results)
    table.replace_series(detail(t.observations, table.read(), t.requests), t.requests)
    return _replaced(table.read())


def _stored_append(t: Tables) -> DataFrame:
    early = F.col("date") < as_date(DAY)
    table = _stored_table(t, t.results.where(early))
    table.append(t.results.where(~early))
    return _replaced(table.read())


def _stored_replay(t: Tables) -> DataFrame:
    """A replay published to results and history."""
    results = _stored_table(t, t.results, "results")
    history = _stored_table(t, alerts(t.results, PLAIN), "history")
    scored = replay(
        t.observations, results.read(), t.kpi_list, t.site_master,
        category=CATEGORY, rule=PLAIN, start=REPLAY_START, end=REPLAY_END,
    )
    publish_range(results, history, scored, PLAIN, REPLAY_START, REPLAY_END, _plain_kpis(t))
    named = [x.read().withColumn("stored", F.lit(n)) for n, x in (("results", results), ("history", history))]
    return counted(named[0].union(named[1]), "stored", "date", "kpi", "status")


def _stored_histories(t: Tables) -> DataFrame:
    """Retention for the histories of categories."""
    root = scratch_path(t.spark, "histories")
    rows = {"core": alerts(t.results, PLAIN).where("kpi like 'disc%'"), CATEGORY: alerts(t.results, PLAIN)}
    tables = {c: DatedTable(t.spark, f"{root}/h_{c}", r.schema) for c, r in rows.items()}
    for category, table in tables.items():
        table.append(rows[category])
    retain_histories(t.spark, root, t.results.schema, KEEP_AS_OF)
    parts = [x.read().withColumn("category", F.lit(c)) for c, x in tables.items()]
    return counted(parts[0].union(parts[1]), "category", "date", "kpi")


def _followed(t: Tables, rows: DataFrame, value: str) -> RecentDays:
    """Recent days that follow stored results, of which the week before the scored day, and a later day, are added by changes."""
    early = F.col("date") < as_date(FOLLOWED_FROM)
    table = _stored_table(t, rows.where(early), "results")
    recent = RecentDays(t.spark, scratch_path(t.spark, "recent"), value)
    recent.start(table)
    week = rows.where(~early)
    table.replace_range(week.where(F.col("date") < as_date(DAY)), FOLLOWED_FROM, DAY)
    table.append(week.where(F.col("date") == as_date(LATER_DAY)))
    return recent


def _score_from_recent(t: Tables) -> DataFrame:
    recent = _followed(t, t.results, "value").before(DAY)
    scored = score_all(t.observations, None, t.kpi_list, t.site_master, category=CATEGORY, day=DAY, recent=recent)
    return rounded(scored)


def _completeness_from_kept(t: Tables) -> DataFrame:
    """Scored from kept tables; of row counts and results only the day itself is read."""
    recent = _followed(t, t.completeness_results, "row_count").before(DAY)
    sites = MisnamedSites(t.spark, scratch_path(t.spark, "misnamed"))
    for start, end in (("0001-01-01", DAY), (DAY, "9999-12-31")):
        sites.feed(t.row_counts, start, end)
    return rounded(score_completeness(t.row_counts, None, sites.read(), day=DAY, recent=recent))


def _retention(t: Tables) -> DataFrame:
    parts = [
        maintain.retain(alerts(t.results, PLAIN), KEEP_AS_OF).select("date", "kpi", "status"),
        maintain.retain(alerts(t.completeness_results, COMPLETENESS), KEEP_AS_OF)
        .select("date", "kpi", "status"),
    ]
    return parts[0].union(parts[1]).groupBy("date", "kpi", "status").agg(
        F.count(F.lit(1)).alias("n")
    )


_QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    "kpi_select": _kpi_select,
    "bad_site_locations": lambda t: bad_site_locations(t.site_master),
    "observations_clean": lambda t: counted(
        with_complete_keys(t.observations), "kpi", "vendor", "level", "location"
    ),
    "kpi_semi_join": lambda t: counted(of_kpis(t.observations, _plain_kpis(t)), "kpi", "location"),
    "site_anti_join": lambda t: counted(
        outside_bad_sites(with_complete_keys(t.observations), t.site_master),
        "kpi", "level", "location",
    ),
    "site_not_in": lambda t: counted(
        not_in_bad_sites(t.row_counts, t.row_counts),
        "kpi", "level", "location", value="row_count",
    ),
    "weekday_name": _weekday_name,
    "weekday_padded": _padded_weekday,
    "replay_dates": _replay_dates,
    "recent_rank": lambda t: _recent(t, KEYS),
    "recent_rank_weekday": lambda t: _recent(t, WITH_WEEKDAY),
    "baseline_band": lambda t: _band(t, PLAIN),
    "baseline_band_weekday": lambda t: _band(t, PLAIN, WITH_WEEKDAY),
    "baseline_rowcount": lambda t: _band(t, COMPLETENESS),
    "baseline_sigma": lambda t: _band(t, SIGMA),
    "baseline_rowcount_detail": lambda t: _band(t, COMPLETENESS_DETAIL),
    "ok_counts": lambda t: accepted_counts(t.results),
    "series_exists": lambda t: series_exists(t.observations, t.requests),
    "score_all": _score_all,
    "history_anomaly": lambda t: alerts(_score(t, PLAIN), PLAIN),
    "completeness_score": _completeness,
    "history_completeness": lambda t: alerts(_completeness(t), COMPLETENESS),
    "detail_anomaly": _detail,
    "detail_init": lambda t: _detail(t).where((F.col("status") == OK) & F.col("rata").isNull()),
    "detail_no_data": lambda t: _detail(t).where(F.col("status") == NO_DATA),
    "detail_completeness": _detail_completeness,
    "completeness_start": lambda t: rounded(
        start_completeness(t.row_counts, t.completeness_results, DAY)
    ),
    "replace_slice": _replace_slice,
    "reseed_class": _reseed,
    "replace_date": _replace_date,
    "replace_series": _replace_series,
    "retention_history": _retention,
    "score_all_look_back": lambda t: _score_all(_by_date(t), LOOK_BACK),
    "completeness_look_back": lambda t: _completeness(_by_date(t), LOOK_BACK),
    "seed_look_back": lambda t: _seed(_by_date(t), PLAIN, LOOK_BACK),
    "stored_slice": _stored_slice,
    "stored_reseed": _stored_reseed,
    "stored_date": _stored_date,
    "stored_series": _stored_series,
    "stored_append": _stored_append,
    "stored_replay": _stored_replay,
    "stored_histories": _stored_histories,
    "stored_recent_score": _score_from_recent,
    "stored_recent_completeness": _completeness_from_kept,
}
for _rule in CLASS_RULES:
    _QUERIES[f"seed_{_rule.name}"] = partial(_seed, rule=_rule)
    _QUERIES[f"score_{_rule.name}"] = partial(_score, rule=_rule)
    _QUERIES[f"replay_{_rule.name}"] = partial(_replay, rule=_rule)
for _rule in (*CLASS_RULES, SIGMA, COMPLETENESS, COMPLETENESS_DETAIL):
    _QUERIES[f"classify_{_rule.name}"] = partial(_classify, rule=_rule)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(make):
        return lambda spark, sf_dir: make(Tables(spark, sf_dir))

    return {name: bound(make) for name, make in _QUERIES.items()}
