"""Ingest profiling (Q1-Q4) and post-load verification (L1-L2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def raw_shape(raw: DataFrame) -> DataFrame:
    """Q1: row count, column count and the column list."""
    cols = ",".join(raw.columns)
    return raw.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(raw.columns)).alias("n_columns"), F.lit(cols).alias("columns"))


def raw_date_range(raw: DataFrame, col: str = "inspection_date") -> DataFrame:
    """Q2: min / max of the raw date *text* (before any parsing)."""
    return raw.agg(F.min(col).alias("min_date_text"), F.max(col).alias("max_date_text"))


def distinct_licenses(raw: DataFrame) -> DataFrame:
    """Q3: distinct raw licence values, nulls excluded."""
    return raw.agg(F.count_distinct("license_").alias("n_licenses"))


def result_distribution(raw: DataFrame) -> DataFrame:
    """Q4: raw result spellings by frequency (nulls excluded)."""
    return (raw.filter(F.col("results").isNotNull()).groupBy("results")
            .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("results")))


def verify_counts(inspections: DataFrame, scores: DataFrame) -> DataFrame:
    """L1: row count of both loaded tables."""
    a = inspections.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("inspections").alias("table_name"), "n_rows")
    b = scores.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("risk_scores").alias("table_name"), "n_rows")
    return a.unionByName(b)


def verify_top(scores: DataFrame, k: int = 5) -> DataFrame:
    """L2: ``k`` highest scores, nulls first (database DESC order), ties by key."""
    return (scores.orderBy(F.col("dynamic_risk_score").desc_nulls_first(), F.col("establishment_id"))
            .limit(k).select("establishment_id", "dba_name", "dynamic_risk_score"))


def key_check(df: DataFrame, key: str, table_name: str) -> DataFrame:
    """K7: primary-key health: rows, distinct keys, null keys, duplicated keys.

    One aggregation per key then one global aggregation; a clean table has
    ``null_keys = duplicate_keys = 0``.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("c"))
    return per_key.agg(
        F.sum("c").cast("long").alias("n_rows"),
        F.count(key).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("c"))), F.lit(0)).cast("long").alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("c") > 1)).alias("duplicate_keys"),
    ).select(F.lit(table_name).alias("table_name"), "*")
