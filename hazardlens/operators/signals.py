"""Violation-text signals (V1-V9): one narrow projection, no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoringConfig
from ..functions import violations as V
from ..functions.numeric import exact_mean, round1


def parse_violations(df: DataFrame, text_col: str = "violations",
                     cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """V7: add codes, tier counts, keyword counts/list and the severity score.

    Adds ``violation_codes`` (array<int>), ``n_critical``, ``n_serious``,
    ``n_minor``, ``kw_critical``, ``kw_major``, ``kw_minor`` (int),
    ``kw_found`` (array<string>, tier order then list order) and
    ``violation_severity`` (double, 2 decimals).
    """
    kw = V.keyword_scan("_places", cfg)
    staged = df.withColumn("_places", V.keyword_places(V.lowered_text(text_col), cfg)).withColumns({
        "violation_codes": V.violation_codes(text_col),
        "_kw_critical": kw["critical"],
        "_kw_major": kw["major"],
        "_kw_minor": kw["minor"],
    })
    tiers = V.code_tier_counts("violation_codes")
    staged = staged.withColumns({
        **tiers,
        "kw_critical": F.size("_kw_critical"),
        "kw_major": F.size("_kw_major"),
        "kw_minor": F.size("_kw_minor"),
        "kw_found": F.concat("_kw_critical", "_kw_major", "_kw_minor"),
    }).drop("_kw_critical", "_kw_major", "_kw_minor", "_places")
    s = V.structured_signal(F.col("n_critical"), F.col("n_serious"), F.col("n_minor"), cfg)
    k = V.keyword_signal(F.col("kw_critical"), F.col("kw_major"), F.col("kw_minor"), cfg)
    return staged.withColumn("violation_severity", V.severity(s, k, cfg))


def _totals() -> list:
    return [F.coalesce(F.sum(F.size("violation_codes")), F.lit(0)).cast("long").alias("total_codes"),
            F.coalesce(F.sum(F.col("kw_critical") + F.col("kw_major") + F.col("kw_minor")), F.lit(0)).cast("long").alias("total_keyword_hits")]


def _severities() -> list:
    sev = F.col("violation_severity")
    return [round1(exact_mean(sev, 2)).alias("mean_severity"), round1(F.median(sev)).alias("median_severity"),
            round1(F.max(sev)).alias("max_severity")]


def signal_totals(signals: DataFrame) -> DataFrame:
    """V8: total codes found and total keyword hits over all rows."""
    return signals.agg(*_totals())


def severity_stats(signals: DataFrame) -> DataFrame:
    """V9: mean / median / max severity, shown to one decimal.

    The median is exact; severities have two decimals in 0..100, so the
    value->count buffer behind it holds at most 10,001 entries.
    """
    return signals.agg(*_severities())


def signal_report(signals: DataFrame) -> DataFrame:
    """V8 + V9 and the number of rows (``n_rows``) in one pass."""
    return signals.agg(F.count(F.lit(1)).alias("n_rows"), *_totals(), *_severities())
