"""The checking rules as data, and the column expressions they stand for."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

OK = "ok"
ANOMALY = "anomaly"
NOT_OK = "not ok"
DUPLICATED = "duplicated"
NO_DATA = "no data"

# Rows taken per series when scoring, when seeding, and the number
# of accepted rows a series needs before it is checked in detail.
SCORE_DEPTH = 7
SEED_DEPTH = 10
MIN_ACCEPTED = 7

# Days of history kept, and the categories it is kept for.
KEEP_DAYS = 31
CATEGORIES = ("availability", "capacity", "core", "ran", "revenue", "transport", "tutela", "vas")


@dataclass(frozen=True)
class Rule:
    """How a value is judged against the band of its series' recent accepted rows.

    ``lower`` and ``upper`` multiply the mean. With ``sigmas`` the band is
    mean -/+ that many sample standard deviations instead, and the factors only
    apply when the recent values are all the same.
    """

    name: str
    value: str = "value"
    rate_status: str | None = None
    trend: str | None = None
    lower: float = 0.90
    upper: float = 1.10
    sigmas: float | None = None
    reject_zero: bool = False
    reject_negative: bool = False
    reject_over_100: bool = False
    reject_null: bool = True
    above: str = ANOMALY
    otherwise: str = ANOMALY
    depth: int = SCORE_DEPTH

    @property
    def by_weekday(self) -> bool:
        """Trend rules compare a day with earlier days of the same weekday only."""
        return self.trend == "T"

    def band(self, mean: Column) -> tuple[Column, Column]:
        """Lower and upper bound as multiples of the mean."""
        return mean * F.lit(self.lower), mean * F.lit(self.upper)

    def rejects(self, value: Column) -> Column:
        """Values that are wrong whatever the band says."""
        wrong = F.lit(False)
        if self.reject_null:
            wrong = wrong | value.isNull()
        if self.reject_zero:
            wrong = wrong | (value == 0)
        if self.reject_negative:
            wrong = wrong | (value < 0)
        if self.reject_over_100:
            wrong = wrong | (value > 100)
        return wrong

    def status(self, value: Column, lower: Column, upper: Column) -> Column:
        """Status of a value; bounds are inclusive and a missing band accepts nothing."""
        return (
            F.when(self.rejects(value), ANOMALY)
            .when((value >= lower) & (value <= upper), OK)
            .when(value > upper, self.above)
            .otherwise(self.otherwise)
        )

    def seedable(self, value: Column) -> Column:
        """Values accepted without a band when a baseline is first filled."""
        return value.between(0, 100) if self.rate_status == "Y" else value > 0

    @property
    def alert(self) -> str:
        """The status that is copied to the history table."""
        return self.otherwise


PLAIN = Rule("plain", rate_status="N", trend="F", reject_zero=True, reject_negative=True)
TREND = Rule("trend", rate_status="N", trend="T", reject_negative=True)
RATE = Rule("rate", rate_status="Y", trend="F", reject_negative=True, reject_over_100=True)
RATE_TREND = Rule(
    "rate_trend", rate_status="Y", trend="T", reject_negative=True, reject_over_100=True
)
CLASS_RULES = (PLAIN, TREND, RATE, RATE_TREND)

SIGMA = Rule("sigma", lower=0.95, upper=1.05, sigmas=3.0, reject_zero=True)

COMPLETENESS = Rule(
    "completeness",
    value="row_count",
    lower=0.92,
    upper=1.08,
    reject_null=False,
    above=DUPLICATED,
    otherwise=NOT_OK,
)
COMPLETENESS_DETAIL = Rule(
    "completeness_detail",
    value="row_count",
    lower=0.95,
    upper=1.05,
    reject_null=False,
    above=DUPLICATED,
    otherwise=NOT_OK,
)
