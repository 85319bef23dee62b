"""Daily KPI tables derived from the TPC-H-like test data, as DataFrames.

Each supplier is a site, each metric and return flag a KPI. The supplier number
modulo 20 (called ``k``) decides which special case the site shows; all values
are whole numbers, so that sums do not depend on their order. ``oracle.py`` holds
the same definitions in SQL; see FIXTURES.md for the cases.

The library works on stored tables, so the derived rows are written once per
application and folder to the scratch folder, sorted by date; the look-back queries read
a copy that is partitioned by date, as the library's own tables are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiwarden.sources.scratch import exists, scratch_path, shuffles_removed

CATEGORY = "ran"
CUT_OFF = "2001-05-31"
DAY = "2001-06-15"
LATER_DAY = "2001-06-18"
FOLLOWED_FROM = "2001-06-08"
REPLAY_START = "2001-06-01"
REPLAY_END = "2001-06-30"
KEEP_AS_OF = "2001-07-01"
NEW_SITE_FROM = "2001-06-01"

# metric: (rate_status, trend, status)
METRICS = {
    "qty": ("N", "F", "include"),
    "price": ("N", "T", "include"),
    "disc": ("Y", "F", "include"),
    "line": ("Y", "T", "include"),
    "tax": ("N", "F", "exclude"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k(s: str) -> Column:
    return F.col(s) % 20


def _padded(number: Column, width: int) -> Column:
    return F.concat(F.lit("S"), F.lpad(number.cast("string"), width, "0"))


def _level(s: str) -> Column:
    return F.when(_k(s) == 11, "cluster").otherwise("site")


def _location(s: str) -> Column:
    return (
        F.when(_k(s) == 10, _padded(F.col(s), 6))
        .when(_k(s) == 11, _padded(F.col(s) - 1, 6))
        .when(_k(s) == 12, F.lit(None).cast("string"))
        .otherwise(_padded(F.col(s), 5))
    )


def _per_metric(df: DataFrame) -> DataFrame:
    """One row per metric, from the sums n, q, p, dc and ln."""
    n, q, p, dc, ln = (F.col(c) for c in ("n", "q", "p", "dc", "ln"))
    values = {
        "qty": 100 + F.floor(q / n),
        "price": 1000 + F.floor(p / (n * 100)),
        "disc": 30 + 2 * F.floor(dc / n),
        "line": 60 + 5 * F.floor(ln / n),
        "tax": F.floor(q / n),
    }
    entries = [
        F.struct(F.lit(m).alias("metric"), v.cast("double").alias("value"))
        for m, v in values.items()
    ]
    exploded = df.withColumn("m", F.explode(F.array(*entries)))
    return exploded.select(
        "d", "s", (100 + q).alias("row_count"), "m.metric", "m.value",
        F.concat("m.metric", F.lit("_"), F.lower("f")).alias("kpi"),
    )


_stored: dict[tuple[str, str, str], tuple[str, DataFrame]] = {}


def _kept(spark: SparkSession, sf_dir: str, name: str, write) -> DataFrame:
    """What ``write`` puts at a path, by the first call of this application and by later ones that find it gone."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored or not exists(spark, _stored[key][0]):
        path = scratch_path(spark, name)
        with shuffles_removed(spark):
            _stored[key] = path, write(path)
    return _stored[key][1]


def _once(spark: SparkSession, sf_dir: str, name: str, make) -> DataFrame:
    """What ``make`` derives, stored and read from there."""

    def write(path: str) -> DataFrame:
        rows = make(spark, sf_dir)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return _kept(spark, sf_dir, name, write)


def _raw(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """The derived rows in few files, sorted by date; or with a folder per date, as the library's own tables."""
    if not by_date:
        return _once(spark, sf_dir, "derived", _derive)

    def write(path: str) -> DataFrame:
        rows = _raw(spark, sf_dir)
        rows.repartition("date").write.partitionBy("date").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    return _kept(spark, sf_dir, "by-date", write)


def _derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.col("l_shipdate").cast("date").alias("d"),
            F.col("l_suppkey").alias("s"),
            F.col("l_returnflag").alias("f"),
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("l_quantity").cast("bigint")).alias("q"),
            F.sum(F.floor("l_extendedprice")).alias("p"),
            F.sum(F.round(F.col("l_discount") * 100).cast("bigint")).alias("dc"),
            F.sum(F.col("l_linenumber").cast("bigint")).alias("ln"),
        )
    )
    k = _k("s")
    sites = _per_metric(base).select(
        F.col("d").alias("date"),
        "s",
        "metric",
        "kpi",
        F.when(k != 13, "daily").alias("granularity"),
        F.when(k != 14, "ran").alias("node"),
        F.when(k != 3, F.concat(F.lit("V"), (F.col("s") % 3).cast("string"))).alias("vendor"),
        _level("s").alias("level"),
        _location("s").alias("location"),
        F.when(k == 0, 0.0)
        .when(k == 1, -5.0)
        .when(k == 2, F.lit(None).cast("double"))
        .when(k == 5, 120.0)
        .when(k == 6, 77.0)
        .otherwise(F.col("value"))
        .alias("value"),
        F.when(k != 2, F.col("row_count")).alias("row_count"),
    )
    twice = (k == 4) & (F.day("date") % 3 == 0)
    sites = sites.withColumn(
        "more", F.explode(F.when(twice, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    )
    sites = sites.withColumns(
        {"value": F.col("value") + F.col("more"), "row_count": F.col("row_count") + F.col("more")}
    ).drop("more")
    sums = base.groupBy("d", "f").agg(*[F.sum(c).alias(c) for c in ("n", "q", "p", "dc", "ln")])
    national = _per_metric(sums.withColumn("s", F.lit(-1).cast("bigint"))).select(
        F.col("d").alias("date"),
        "s",
        "metric",
        "kpi",
        F.lit("daily").alias("granularity"),
        F.lit("ran").alias("node"),
        F.lit("ALL").alias("vendor"),
        F.lit("national").alias("level"),
        F.lit("ALL").alias("location"),
        "value",
        "row_count",
    )
    return sites.unionByName(national).sortWithinPartitions("date", "kpi")


_KEY_COLUMNS = ("date", "kpi", "granularity", "node", "vendor", "level", "location")


def observations(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    return _raw(spark, sf_dir, by_date).select(*_KEY_COLUMNS, "value")


def row_counts(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    return _raw(spark, sf_dir, by_date).select(*_KEY_COLUMNS, "row_count")


def _twice_loaded(df: DataFrame) -> DataFrame:
    return df.withColumn("copies", F.when(_k("s") == 7, 2).otherwise(1)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("copies")))
    )


def results(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """Anomaly results of all dates, as earlier runs might have left them."""
    value = F.col("value")
    usable = (
        (value > 0)
        & (F.col("row_count") % 7 != 2)
        & (~F.col("metric").isin("disc", "line") | (value <= 100))
        & ((_k("s") != 8) | (F.col("date") >= F.lit(NEW_SITE_FROM).cast("date")))
    )
    return _twice_loaded(_raw(spark, sf_dir, by_date)).select(
        *_KEY_COLUMNS,
        "value",
        (value + 10).alias("b_atas"),
        (value - 10).alias("b_bawah"),
        value.alias("rata"),
        F.when(usable, "ok").otherwise("anomaly").alias("status"),
    )


def completeness_results(spark: SparkSession, sf_dir: str, by_date: bool = False) -> DataFrame:
    """Completeness results of all dates, as earlier runs might have left them."""
    count = F.col("row_count")
    usable = (count % 7 != 2) & (
        (_k("s") != 8) | (F.col("date") >= F.lit(NEW_SITE_FROM).cast("date"))
    )
    bound = count.cast("double")
    return _twice_loaded(_raw(spark, sf_dir, by_date)).select(
        *_KEY_COLUMNS,
        "row_count",
        (bound + 10).alias("b_atas"),
        (bound - 10).alias("b_bawah"),
        bound.alias("rata"),
        F.when(usable, "ok").otherwise("not ok").alias("status"),
    )


def site_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        _level("s_suppkey").alias("level"), _location("s_suppkey").alias("location")
    )


def kpi_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One KPI per metric and return flag; some also listed in another category."""
    return _once(spark, sf_dir, "kpi-list", _kpi_list)


def _kpi_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = [
        F.struct(F.lit(m).alias("metric"), *[F.lit(v).alias(c) for c, v in zip(
            ("rate_status", "trend", "status", "category"), entry)])
        for m, entry in [(m, (*c, CATEGORY)) for m, c in METRICS.items()]
        + [("disc", ("N", "F", "include", "core"))]
    ]
    flags = table(spark, sf_dir, "lineitem").select(F.lower("l_returnflag").alias("f")).distinct()
    return flags.withColumn("m", F.explode(F.array(*entries))).select(
        F.concat("m.metric", F.lit("_"), F.col("f")).alias("kpi"),
        "m.status", "m.rate_status", "m.trend", "m.category",
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series, asked for on two days."""
    return _once(spark, sf_dir, "requests", _requests)


def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = F.array(F.lit(DAY).cast("date"), F.lit(LATER_DAY).cast("date"))
    series = observations(spark, sf_dir).select(*_KEY_COLUMNS[1:]).distinct()
    return series.select(F.explode(days).alias("date"), *_KEY_COLUMNS[1:])
