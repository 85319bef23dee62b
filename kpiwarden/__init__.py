"""Anomaly and completeness checks for daily KPI series, as Spark jobs."""

from kpiwarden.functions.rules import (
    COMPLETENESS,
    COMPLETENESS_DETAIL,
    PLAIN,
    RATE,
    RATE_TREND,
    SIGMA,
    TREND,
    Rule,
)
from kpiwarden.plans.detail import detail, detail_completeness, start_completeness
from kpiwarden.plans.replay import replay
from kpiwarden.plans.score import alerts, score, score_all, score_completeness
from kpiwarden.plans.seed import seed
from kpiwarden.sources.kept import MisnamedSites, RecentDays
from kpiwarden.sources.store import DatedTable, publish_day, publish_range, retain_histories

__all__ = [
    "COMPLETENESS", "COMPLETENESS_DETAIL", "PLAIN", "RATE", "RATE_TREND", "SIGMA", "TREND",
    "DatedTable", "MisnamedSites", "RecentDays", "Rule", "alerts", "detail", "detail_completeness", "publish_day",
    "publish_range", "replay", "retain_histories", "score", "score_all", "score_completeness", "seed", "start_completeness",
]
