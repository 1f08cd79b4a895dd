"""Explicit schemas for every table boundary (raw, inspections, scores)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()

# Raw API record: everything is text, plus our own landing order.
RAW_TEXT_COLUMNS = [
    "inspection_id", "dba_name", "aka_name", "license_", "facility_type", "risk",
    "address", "zip", "inspection_date", "inspection_type", "results",
    "violations", "latitude", "longitude",
]
RAW = T.StructType(
    [T.StructField(c, S, True) for c in RAW_TEXT_COLUMNS]
    + [T.StructField("ingest_seq", T.LongType(), True)]
)

# A reader's own order of a record: (file, place in it), a struct that sorts as landed.
LANDING = "landing"
# The micro-batch a record came with, in the refresh stream.
BATCH = "_batch"

# Columns that later steps add, so that no landed key may keep their names.
DERIVED = {"establishment_id", "result_score", "n_critical", "n_serious", "n_minor", "kw_critical", "kw_major", "kw_minor",
           "kw_found", "violation_codes", "violation_severity", "ingest_seq", LANDING, BATCH}

# Columns the cleaning step reads without a guard.
RAW_REQUIRED = ["dba_name", "address", "license_", "inspection_date",
                "inspection_type", "results", "violations"]

INSPECTIONS = T.StructType([
    T.StructField("inspection_id", S), T.StructField("establishment_id", S),
    T.StructField("dba_name", S), T.StructField("aka_name", S),
    T.StructField("license_", S), T.StructField("facility_type", S),
    T.StructField("risk", S), T.StructField("address", S), T.StructField("zip", S),
    T.StructField("inspection_date", T.TimestampNTZType()),
    T.StructField("inspection_type", S), T.StructField("results", S),
    T.StructField("result_score", T.DoubleType()), T.StructField("violations", S),
    T.StructField("n_critical", T.IntegerType()), T.StructField("n_serious", T.IntegerType()),
    T.StructField("n_minor", T.IntegerType()), T.StructField("kw_critical", T.IntegerType()),
    T.StructField("kw_major", T.IntegerType()), T.StructField("kw_minor", T.IntegerType()),
    T.StructField("violation_severity", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
])
INSPECTION_COLUMNS = INSPECTIONS.fieldNames()

SCORES = T.StructType([
    T.StructField("establishment_id", S), T.StructField("dba_name", S),
    T.StructField("aka_name", S), T.StructField("address", S), T.StructField("zip", S),
    T.StructField("facility_type", S), T.StructField("risk_category", S),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("total_inspections", T.IntegerType()),
    T.StructField("total_failures", T.IntegerType()),
    T.StructField("total_conditional", T.IntegerType()),
    T.StructField("total_passes", T.IntegerType()),
    T.StructField("last_inspection_date", T.TimestampNTZType()),
    T.StructField("last_result", S),
    T.StructField("failure_rate_score", T.DoubleType()),
    T.StructField("recency_score", T.DoubleType()),
    T.StructField("violation_severity_score", T.DoubleType()),
    T.StructField("trend_score", T.DoubleType()),
    T.StructField("dynamic_risk_score", T.DoubleType()),
])
SCORE_COLUMNS = SCORES.fieldNames()

# The sink narrows doubles to 4-byte REAL and counts to INTEGER.
_SINK_NARROW = {T.DoubleType(): T.FloatType(), T.LongType(): T.IntegerType()}


def ensure_columns(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Add every column of ``schema`` missing from ``df`` as a typed literal.

    Present columns are left untouched; absent ones become ``defaults[name]``
    (or null) cast to the schema type. Pure projection, no data movement.
    """
    defaults = defaults or {}
    present = set(df.columns)
    extra = [F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)
             for f in schema.fields if f.name not in present]
    return df.select("*", *extra) if extra else df


def to_sink_schema(df: DataFrame) -> DataFrame:
    """Narrow doubles to float and longs to int, as the database tables store them."""
    cols: list[Column] = []
    for f in df.schema.fields:
        target = _SINK_NARROW.get(f.dataType)
        cols.append(F.col(f.name).cast(target).alias(f.name) if target else F.col(f.name))
    return df.select(cols)
