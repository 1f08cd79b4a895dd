"""Exploration mode (X1-X4): a reproducible look at parsed violation text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_TEXT = 50
SAMPLE_SIZE = 5
SAMPLE_SEED = "42"
PREVIEW_CHARS = 500


def explore_candidates(signals: DataFrame, min_chars: int = MIN_TEXT) -> DataFrame:
    """Failed inspections with more than ``min_chars`` of violation text."""
    return signals.filter((F.col("results") == "fail") & (F.length("violations") > min_chars))


def explore_sample(signals: DataFrame, n: int = SAMPLE_SIZE, seed: str = SAMPLE_SEED) -> DataFrame:
    """``n`` candidates in a seeded hash order — same rows on every engine and run."""
    order = F.md5(F.concat(F.col("inspection_id"), F.lit(seed)))
    return explore_candidates(signals).orderBy(order, F.col("inspection_id")).limit(n)


def explore_report(sample: DataFrame) -> DataFrame:
    """What the parsers extracted for each sampled inspection."""
    return sample.select(
        "inspection_id", "dba_name", F.date_format("inspection_date", "yyyy-MM-dd").alias("inspection_day"),
        "results", "risk", "facility_type",
        F.substring("violations", 1, PREVIEW_CHARS).alias("violations_preview"),
        F.array_join("violation_codes", ",").alias("violation_codes"),
        "n_critical", "n_serious", "n_minor",
        F.array_join("kw_found", ",").alias("kw_found"),
        "kw_critical", "kw_major", "kw_minor", "violation_severity",
    )
