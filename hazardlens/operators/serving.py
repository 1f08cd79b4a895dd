"""Analyst queries over the scores / inspections tables.

Each function takes DataFrames plus explicit parameters and returns a lazy
DataFrame. Top-k results use ``orderBy(...).limit(k)`` with a key tie-break,
which Spark plans as ``TakeOrderedAndProject`` (per-partition top-k, then a
k-row merge) — nothing unbounded reaches one task.
"""

from __future__ import annotations

import time
import weakref
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import HIGH_RISK, MEDIUM_RISK, TREND_IMPROVING, TREND_WORSENING
from ..functions.numeric import clamp, exact_mean, round1
from ..functions.text import contains_literal, contains_regex

SCORE = "dynamic_risk_score"
KEY = "establishment_id"

# Display names of the top-N table, in display order.
TOP_N_COLUMNS = {
    "dba_name": "Name", "address": "Address", "zip": "ZIP", "facility_type": "Type",
    "dynamic_risk_score": "Risk Score", "failure_rate_score": "Failure Rate",
    "violation_severity_score": "Violation Severity", "recency_score": "Recency",
    "trend_score": "Trend", "total_inspections": "Inspections",
    "total_failures": "Failures", "last_result": "Last Result",
}
HISTORY_COLUMNS = {
    "inspection_date": "Date", "inspection_type": "Type", "results": "Result",
    "violation_severity": "Severity", "n_critical": "Critical", "n_serious": "Serious",
}
# Columns the dashboard pulls from the inspections table.
INSPECTION_VIEW_COLUMNS = ["inspection_id", "establishment_id", "dba_name", "inspection_date",
                           "inspection_type", "results", "result_score", "violation_severity",
                           "n_critical", "n_serious"]


def by_score_desc(*more: Column) -> list[Column]:
    return [F.col(SCORE).desc_nulls_last(), F.col(KEY).asc(), *more]


def facets(scores: DataFrame) -> DataFrame:
    """Sorted distinct facility types and ZIPs (nulls dropped) as (facet, value)."""
    ft = scores.select(F.lit("facility_type").alias("facet"), F.col("facility_type").alias("value"))
    zp = scores.select(F.lit("zip").alias("facet"), F.col("zip").alias("value"))
    return ft.unionByName(zp).filter(F.col("value").isNotNull()).distinct().orderBy("facet", "value")


def score_range(scores: DataFrame, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Inclusive score range; null scores never pass."""
    return scores.filter(F.col(SCORE).between(lo, hi))


def multi_select(scores: DataFrame, facility_types: Sequence[str] = (), zips: Sequence[str] = ()) -> DataFrame:
    """D3: AND of the facet selections; an empty selection means no filter."""
    if facility_types:
        scores = scores.filter(F.col("facility_type").isin(list(facility_types)))
    if zips:
        scores = scores.filter(F.col("zip").isin(list(zips)))
    return scores


def apply_filters(scores: DataFrame, lo: float = 0.0, hi: float = 100.0,
                  facility_types: Sequence[str] = (), zips: Sequence[str] = ()) -> DataFrame:
    """D2 + D3 together, as the dashboard applies them."""
    return multi_select(score_range(scores, lo, hi), facility_types, zips)


def kpis(filtered: DataFrame) -> DataFrame:
    """Establishments, high-risk count, mean score, failures, inspections."""
    s = F.col(SCORE)
    return filtered.agg(
        F.count(F.lit(1)).alias("establishments"),
        F.count_if(s >= HIGH_RISK).alias("high_risk"),
        exact_mean(s, 1).alias("avg_risk_score"),
        F.sum("total_failures").cast("long").alias("total_failures"),
        F.sum("total_inspections").cast("long").alias("total_inspections"),
    )


def map_points(filtered: DataFrame) -> DataFrame:
    """Points with coordinates; marker size grows with the score (10..70)."""
    size = clamp(F.col(SCORE) / F.lit(100.0) * F.lit(60.0) + F.lit(10.0), 10.0, 70.0)
    return (filtered.dropna(subset=["latitude", "longitude"])
            .select(KEY, "latitude", "longitude", SCORE, size.alias("size")))


def top_n(filtered: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` riskiest with the 12 display columns, renamed."""
    present = [c for c in TOP_N_COLUMNS if c in filtered.columns]
    ranked = filtered.orderBy(*by_score_desc()).limit(n)
    return ranked.select([F.col(c).alias(TOP_N_COLUMNS[c]) for c in present])


# FIXED VALUES: round bin widths of a histogram over scores.
HISTOGRAM_STEPS = (0.1, 0.2, 0.5, 1, 2, 5, 10, 20, 50, 100, 200, 500, 1000)


def score_histogram(filtered: DataFrame, bins: int = 25) -> DataFrame:
    """Count per score bin, at most ``bins`` equal bins of a round width over
    the scores' range (null scores dropped).

    The width is the smallest of ``HISTOGRAM_STEPS`` that covers the range; bins
    start at multiples of it, and the maximum falls in the last bin even where
    it is that bin's end. One scan: the scores' value counts (one decimal in
    0..100, so at most 1,001) give the range and then the bins.
    """
    values = filtered.filter(F.col(SCORE).isNotNull()).groupBy(F.col(SCORE).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    return histogram_of_counts(values, bins)


def histogram_of_counts(values: DataFrame, bins: int) -> DataFrame:
    """D7 from the scores' value counts ``s, n``."""
    s = F.col("s")
    whole = values.agg(F.collect_list(F.struct("s", "n")).alias("values"), F.min("s").alias("lo"), F.max("s").alias("hi"))

    def last_bin(step: Column) -> Column:
        return F.greatest(F.ceil(F.col("hi") / step) - 1, F.floor(F.col("lo") / step))

    steps = F.array(*(F.lit(float(w)) for w in sorted(HISTOGRAM_STEPS)))
    fits = F.filter(steps, lambda w: last_bin(w) - F.floor(F.col("lo") / w) + 1 <= bins)
    ranged = whole.withColumn("step", F.get(fits, 0)).withColumn("last", last_bin(F.col("step")))
    counts = ranged.select("step", "last", F.inline("values"))
    start = (F.least(F.floor(s / F.col("step")), F.col("last")) * F.col("step")).cast("double")
    return (counts.groupBy(start.alias("bin_start"), "step").agg(F.sum("n").alias("establishments"))
            .select("bin_start", (F.col("bin_start") + F.col("step")).alias("bin_end"), "establishments"))


def risk_by_facility(filtered: DataFrame, min_n: int = 10, k: int = 15) -> DataFrame:
    """Mean score per facility type with at least ``min_n`` scores, top ``k``."""
    s = F.col(SCORE)
    return (filtered.filter(F.col("facility_type").isNotNull())
            .groupBy("facility_type")
            .agg(exact_mean(s, 1).alias("avg_risk"), F.count(s).alias("n"))
            .filter(F.col("n") >= min_n)
            .orderBy(F.col("avg_risk").desc(), F.col("facility_type"))
            .limit(k))


def search(scores: DataFrame, term: str, literal: bool = False) -> DataFrame:
    """Name / alias / address containing ``term`` (lower-cased; regex by default)."""
    if not term:
        return scores
    t = term.lower()
    hit = contains_literal if literal else contains_regex
    return scores.filter(hit("dba_name", t) | hit("aka_name", t) | hit("address", t))


def search_top(scores: DataFrame, term: str, k: int = 20, literal: bool = False) -> DataFrame:
    """The ``k`` riskiest matches."""
    return search(scores, term, literal).orderBy(*by_score_desc()).limit(k)


def risk_band(score: Column) -> Column:
    """High (>=70) / medium (>=40) / low."""
    return (F.when(score >= HIGH_RISK, F.lit("high"))
            .when(score >= MEDIUM_RISK, F.lit("medium")).otherwise(F.lit("low")))


def trend_label(trend: Column) -> Column:
    """Worsening above 55, Improving below 45, else Stable (missing -> 50)."""
    t = F.coalesce(trend, F.lit(50.0))
    return (F.when(t > TREND_WORSENING, F.lit("Worsening"))
            .when(t < TREND_IMPROVING, F.lit("Improving")).otherwise(F.lit("Stable")))


# Fallbacks used when a column is missing from the scores table.
CARD_DEFAULTS = {"failure_rate_score": 0.0, "recency_score": 0.0, "violation_severity_score": 0.0,
                 "trend_score": 50.0, "facility_type": "N/A", "risk_category": "N/A",
                 "total_inspections": 0}


def _whole(c: Column) -> Column:
    """Score shown as a whole number out of 100 (half-even)."""
    return F.concat(F.rint(c).cast("long").cast("string"), F.lit("/100"))


def detail_card(matches: DataFrame) -> DataFrame:
    """The drill-down card: component scores, trend label and caption fields."""
    df = matches
    for c, v in CARD_DEFAULTS.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(v))
    if "last_inspection_date" not in df.columns:
        df = df.withColumn("last_inspection_date", F.lit(None).cast("timestamp_ntz"))
    return df.select(
        KEY,
        _whole(F.col("failure_rate_score")).alias("failure_rate"),
        _whole(F.col("recency_score")).alias("recency"),
        _whole(F.col("violation_severity_score")).alias("violation_severity"),
        trend_label(F.col("trend_score")).alias("trend"),
        F.col("facility_type").alias("type"),
        F.col("risk_category").alias("city_risk_category"),
        F.col("total_inspections").alias("inspections"),
        F.coalesce(F.date_format("last_inspection_date", "yyyy-MM-dd"), F.lit("N/A")).alias("last_inspected"),
    )


def card_label(matches: DataFrame) -> DataFrame:
    """D14: 'name — address — Score: x' with the risk band."""
    na = F.lit("N/A")
    label = F.concat(F.coalesce(F.col("dba_name"), na), F.lit(" — "), F.coalesce(F.col("address"), na),
                     F.lit(" — Score: "), F.coalesce(F.col(SCORE).cast("string"), na))
    return matches.select(KEY, risk_band(F.col(SCORE)).alias("band"), label.alias("label"))


def inspection_history(matches: DataFrame, inspections: DataFrame, k: int = 10) -> DataFrame:
    """Newest ``k`` inspections of every matched establishment, in one join.

    ``matches`` may be of any size: whether its keys are broadcast is left to
    their measured size. The per-key limit is planned as a ``WindowGroupLimit``.
    """
    keys = matches.select(KEY)
    hist = inspections.join(keys, KEY, "left_semi")
    w = Window.partitionBy(KEY).orderBy(F.col("inspection_date").desc(), F.col("inspection_id").desc())
    top = hist.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(KEY, "rank", *[F.col(c).alias(a) for c, a in HISTORY_COLUMNS.items()])


def risk_by_zip(filtered: DataFrame, min_n: int = 5) -> DataFrame:
    """Per ZIP mean score, establishments, high-risk count; at least ``min_n``."""
    s = F.col(SCORE)
    return (filtered.filter(F.col("zip").isNotNull())
            .groupBy("zip")
            .agg(exact_mean(s, 1).alias("avg_risk"),
                 F.count(KEY).alias("n_establishments"),
                 F.count_if(s >= HIGH_RISK).alias("high_risk"))
            .filter(F.col("n_establishments") >= min_n))


def zip_table(filtered: DataFrame, k: int = 15) -> DataFrame:
    """Top ``k`` ZIPs by mean score, numbers rounded to one decimal."""
    top = risk_by_zip(filtered).orderBy(F.col("avg_risk").desc(), F.col("zip")).limit(k)
    return top.select(F.col("zip").alias("ZIP"), round1("avg_risk").alias("Avg Risk"),
                      F.col("n_establishments").alias("Establishments"),
                      F.col("high_risk").alias("High Risk (>=70)"))


def zip_chart(filtered: DataFrame, k: int = 20) -> DataFrame:
    """Top ``k`` ZIPs by mean score, unrounded (chart data)."""
    return risk_by_zip(filtered).orderBy(F.col("avg_risk").desc(), F.col("zip")).limit(k)


CACHE_TTL_SECONDS = 3600
# Per session (dropped with it): (path, format) -> (time read, frame).
_TTL_CACHE: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def load_cached(spark, path: str, fmt: str = "parquet", ttl: float = CACHE_TTL_SECONDS) -> DataFrame:
    """D19 with expiry: a table read once and cached for ``ttl`` seconds.

    After the ttl the stale copy is unpersisted and the table is read again,
    so a refreshed table becomes visible within one ttl. The cache lives in
    executor memory (spilling to disk); on executor loss Spark recomputes
    the lost blocks from the file scan.
    """
    own = _TTL_CACHE.setdefault(spark, {})
    key = (path, fmt)
    now = time.monotonic()
    hit = own.get(key)
    if hit is not None and now - hit[0] < ttl:
        return hit[1]
    if hit is not None:
        hit[1].unpersist()
    df = spark.read.format(fmt).load(path).cache()
    own[key] = (now, df)
    return df


def release_cached(spark, path: str | None = None) -> None:
    """Drop the session's cached tables (of one path, or all)."""
    own = _TTL_CACHE.get(spark, {})
    for key in [k for k in own if path in (None, k[0])]:
        own.pop(key)[1].unpersist()


def inspections_view(inspections: DataFrame) -> DataFrame:
    """The 10 inspection columns the dashboard reads (ordering left to the consumer)."""
    return inspections.select(INSPECTION_VIEW_COLUMNS)
