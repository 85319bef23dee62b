"""Column lists and schemas of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A series is all rows that share these six values.
KEYS = ("kpi", "granularity", "node", "vendor", "level", "location")

# Every key except vendor has to be filled before a row is scored or seeded.
REQUIRED_KEYS = ("kpi", "granularity", "node", "level", "location")

# Upper bound, lower bound and mean of the band a row was checked against.
BOUNDS = ("b_atas", "b_bawah", "rata")

_KEY_FIELDS = [T.StructField(k, T.StringType()) for k in KEYS]
_BOUND_FIELDS = [T.StructField(b, T.DoubleType()) for b in BOUNDS]
_DATE = T.StructField("date", T.DateType())
_VALUE = T.StructField("value", T.DoubleType())
_ROW_COUNT = T.StructField("row_count", T.LongType())
_STATUS = T.StructField("status", T.StringType())

OBSERVATIONS = T.StructType([_DATE, *_KEY_FIELDS, _VALUE])
ROW_COUNTS = T.StructType([_DATE, *_KEY_FIELDS, _ROW_COUNT])
ANOMALY_RESULTS = T.StructType([_DATE, *_KEY_FIELDS, _VALUE, *_BOUND_FIELDS, _STATUS])
COMPLETENESS_RESULTS = T.StructType(
    [_DATE, *_KEY_FIELDS, _ROW_COUNT, *_BOUND_FIELDS, _STATUS]
)
REQUESTS = T.StructType([_DATE, *_KEY_FIELDS])
SITES = T.StructType(
    [T.StructField("level", T.StringType()), T.StructField("location", T.StringType())]
)
KPI_LIST = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in ("kpi", "status", "rate_status", "trend", "category")
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Return the schema's columns, in its order and cast to its types."""
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
