"""Establishment scoring.

Plan shape (per establishment key ``establishment_id``):

* **Totals branch** — one hash aggregate: counts, exact integer sums for the
  weighted failure rate and mean severity, last failure date. Partial
  aggregation runs map-side, so a hot key (one shared licence holding a
  third of all rows) is pre-reduced to one row per map task before the
  shuffle.
* **Recent branch** — ``row_number()`` over the key, newest first, filtered
  to the trend window (5). Spark plans this as a partial
  ``WindowGroupLimit`` before the exchange, so at most 5 rows per key per
  map task cross the network; the latest row and the recent average are read
  from those rows.
* The two one-row-per-key results join on the key; both sides are already
  hash-partitioned on it, so the join adds no exchange.

No Python runs per row; lookups are literal maps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoringConfig
from ..functions.numeric import clamp, exact_mean, floor_days, round1, scaled
from ..schemas import SCORE_COLUMNS
from .ordering import rank_within_key

KEY = "establishment_id"
LATEST_FIELDS = ["dba_name", "aka_name", "address", "zip", "facility_type", "risk",
                 "latitude", "longitude", "inspection_date", "results"]


def as_of_literal(as_of) -> Column:
    """Clock of the score as a zone-less timestamp literal."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def type_weight(inspection_type: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """Inspection-type weight as DECIMAL(2,1), default for unlisted/null types."""
    pairs = []
    for k, v in cfg.type_weights.items():
        pairs += [F.lit(k), F.lit(v).cast("decimal(2,1)")]
    lookup = F.try_element_at(F.create_map(*pairs), inspection_type)
    return F.coalesce(lookup, F.lit(cfg.type_weight_default).cast("decimal(2,1)"))


def scoring_input(inspections: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """R1 + R3: rows with a key, plus their inspection-type weight."""
    return (inspections.filter(F.col(KEY).isNotNull())
            .withColumn("type_weight", type_weight(F.col("inspection_type"), cfg)))


def newest_first() -> list[Column]:
    """Newest inspection first; the id breaks same-day ties (a total order per key)."""
    return [F.col("inspection_date").desc(), F.col("inspection_id").desc()]


def inspection_order(inspections: DataFrame) -> DataFrame:
    """R2: position of each inspection inside its establishment, newest = 1.

    Ties on the date are broken by ``inspection_id`` so the order is total.
    Ranks come from a distributed global index over the three columns, so no
    establishment is gathered in one task.
    """
    keys = inspections.filter(F.col(KEY).isNotNull()).select("inspection_id", KEY, "inspection_date")
    return rank_within_key(keys, KEY, newest_first(), "recency_rank")


def _totals(scored_in: DataFrame) -> DataFrame:
    s = F.col("result_score")
    # score (tenths) x weight (tenths) = hundredths; exact long sums.
    sw = F.sum(scaled("result_score", 1) * scaled("type_weight", 1)) / F.lit(100.0)
    w = F.sum(scaled("type_weight", 1)) / F.lit(10.0)
    last_fail = F.max(F.when(s > 0, F.col("inspection_date")))
    return scored_in.groupBy(KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(s == 1.0).alias("n_fail"),
        F.count_if(s == 0.5).alias("n_conditional"),
        F.count_if(s == 0.0).alias("n_pass"),
        sw.alias("weighted_failures"),
        w.alias("total_weight"),
        last_fail.alias("last_failure_date"),
        exact_mean("violation_severity", 2).alias("severity_mean"),
        exact_mean(s, 1).alias("overall_avg"),
    )


def _with_days(totals: DataFrame, as_of) -> DataFrame:
    return totals.withColumn("days_since_failure", floor_days("last_failure_date", as_of_literal(as_of)))


def establishment_totals(scored_in: DataFrame, as_of, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """Totals branch: everything decomposable, one hash aggregate."""
    return _with_days(_totals(scored_in), as_of)


def recent_rows(scored_in: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """The newest ``trend_window`` inspections per key (rank 1 = latest).

    A rank *filter*: Spark limits each key to ``trend_window`` rows per map
    task before the shuffle (partial ``WindowGroupLimit``), so hot keys are safe.
    """
    w = Window.partitionBy(KEY).orderBy(*newest_first())
    ranked = scored_in.filter(F.col(KEY).isNotNull()).withColumn("recency_rank", F.row_number().over(w))
    return ranked.filter(F.col("recency_rank") <= cfg.trend_window)


def recent_summary(scored_in: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """Recent branch: average outcome of the trend window and the latest row."""
    rows = recent_rows(scored_in, cfg)
    latest = F.max(F.when(F.col("recency_rank") == 1, F.struct(*[F.col(c) for c in LATEST_FIELDS])))
    return rows.groupBy(KEY).agg(
        exact_mean("result_score", 1).alias("recent_avg"),
        latest.alias("latest"),
    )


def establishment_state(inspections: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per establishment, all that scoring needs of its inspections, whatever the clock."""
    inp = scoring_input(inspections, cfg)
    return _totals(inp).join(recent_summary(inp, cfg), KEY)


def components(inspections: DataFrame, as_of, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per establishment: counts, latest row and the four unrounded components."""
    return _components(establishment_state(inspections, cfg), as_of, cfg)


def _components(state: DataFrame, as_of, cfg: ScoringConfig) -> DataFrame:
    j = _with_days(state, as_of)
    rw = cfg.risk_weights
    failure = F.when(F.col("total_weight") > 0,
                     F.col("weighted_failures") / F.col("total_weight")).otherwise(F.lit(0.0)) * F.lit(100.0)
    recency = F.when(F.col("last_failure_date").isNull(), F.lit(0.0)).otherwise(
        F.lit(100.0) * F.exp(F.lit(-cfg.recency_decay) * F.col("days_since_failure") / F.lit(cfg.half_life_days)))
    trend = F.when(F.col("n") >= cfg.trend_min_inspections,
                   clamp(F.lit(50.0) + (F.col("recent_avg") - F.col("overall_avg")) * F.lit(50.0), 0.0, 100.0)
                   ).otherwise(F.lit(50.0))
    j = j.withColumns({"failure_rate": failure, "recency": recency,
                       "severity": F.col("severity_mean"), "trend": trend})
    composite = (F.lit(rw["failure_rate"]) * F.col("failure_rate") + F.lit(rw["recency"]) * F.col("recency")
                 + F.lit(rw["violation_severity"]) * F.col("severity") + F.lit(rw["trend"]) * F.col("trend"))
    return j.withColumn("composite", composite)


def risk_scores(inspections: DataFrame, as_of, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """One row per establishment with the 20 published columns."""
    return scores_of_state(establishment_state(inspections, cfg), as_of, cfg)


def scores_of_state(state: DataFrame, as_of, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """R1-R13 from stored states: a projection, without a shuffle."""
    c = _components(state, as_of, cfg)
    out = c.select(
        F.col(KEY),
        F.col("latest.dba_name").alias("dba_name"),
        F.col("latest.aka_name").alias("aka_name"),
        F.col("latest.address").alias("address"),
        F.col("latest.zip").alias("zip"),
        F.col("latest.facility_type").alias("facility_type"),
        F.col("latest.risk").alias("risk_category"),
        F.col("latest.latitude").alias("latitude"),
        F.col("latest.longitude").alias("longitude"),
        F.col("n").cast("int").alias("total_inspections"),
        F.col("n_fail").cast("int").alias("total_failures"),
        F.col("n_conditional").cast("int").alias("total_conditional"),
        F.col("n_pass").cast("int").alias("total_passes"),
        F.col("latest.inspection_date").alias("last_inspection_date"),
        F.col("latest.results").alias("last_result"),
        round1("failure_rate").alias("failure_rate_score"),
        round1("recency").alias("recency_score"),
        round1("severity").alias("violation_severity_score"),
        round1("trend").alias("trend_score"),
        round1(clamp(F.col("composite"), 0.0, 100.0)).alias("dynamic_risk_score"),
    )
    return out.select(SCORE_COLUMNS)


def score_distribution(scores: DataFrame, col: str = "dynamic_risk_score") -> DataFrame:
    """N, mean, median, sample std of the composite, one decimal.

    Scores have one decimal in 0..100, so the exact median's value->count
    buffer is bounded by 1,001 entries regardless of row count.
    """
    x = F.col(col)
    return scores.agg(
        F.count(x).alias("n"),
        round1(exact_mean(x, 1)).alias("mean_score"),
        round1(F.median(x)).alias("median_score"),
        round1(F.stddev_samp(x)).alias("std_score"),
        F.max(x).alias("max_score"),
    )


def top_riskiest(scores: DataFrame, n: int = 10, name_width: int = 40) -> DataFrame:
    """The ``n`` highest composites, ties by key (TakeOrderedAndProject)."""
    return (scores.orderBy(F.col("dynamic_risk_score").desc_nulls_last(), F.col(KEY))
            .limit(n)
            .select(KEY, "dynamic_risk_score",
                    F.substring("dba_name", 1, name_width).alias("dba_name"), "address"))
