"""The batch transform job: raw records -> inspections table + scores table.

``read ids -> read, clean and extract text signals (narrow: superseded records
are dropped in the scan) -> write -> scoring (exchanges on establishment_id) -> write``. The
inspections are written first and the scores are computed from the written
table, which cuts lineage and lets both scoring branches scan columnar files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoringConfig
from ..functions.text import norm, safe_timestamp
from ..operators.clean import clean, repeated_ids, require_columns, usable_records
from ..operators.explore import explore_report, explore_sample
from ..operators.scoring import risk_scores
from ..operators.signals import parse_violations, signal_report
from ..schemas import LANDING
from ..sinks.writers import clustered_scores, require_key, require_key_count, switch_in, write_parquet


@dataclass
class TransformResult:
    inspections: DataFrame
    scores: DataFrame | None
    report: DataFrame | None = None
    counters: dict | None = None


def _observed(raw: DataFrame, cfg: ScoringConfig) -> tuple[DataFrame, Observation]:
    """C15 counters computed *during* the write job (no extra pass over the raw data)."""
    obs = Observation("clean_counters")
    d = safe_timestamp("inspection_date")
    usable = F.coalesce(norm("results").isin(cfg.usable_results), F.lit(False))
    require_columns(raw)
    observed = raw.observe(
        obs,
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(d.isNull()).alias("bad_dates"),
        F.count_if(d.isNotNull() & ~usable).alias("unusable_results"),
        F.count_if(d.isNotNull() & usable).alias("remaining"),
    )
    return observed, obs


def transform(raw: DataFrame, as_of, cfg: ScoringConfig = DEFAULT_CONFIG) -> tuple[DataFrame, DataFrame]:
    """Lazy plan: (inspections with signals, risk scores)."""
    inspections = parse_violations(clean(raw, cfg), cfg=cfg)
    return inspections, risk_scores(inspections, as_of, cfg)


def run_transform(spark: SparkSession, raw: DataFrame, as_of, out_dir: str | None = None,
                  mode: str = "score", cfg: ScoringConfig = DEFAULT_CONFIG) -> TransformResult:
    """X4 mode switch: ``explore`` returns the sample report instead of scoring/saving.

    In ``score`` mode with ``out_dir`` the inspections (without ``kw_found``)
    are written, the scores are computed from that written table and written
    next to it, clustered by ZIP and score (K8). Both are complete and pass the
    key check (K7) before they replace tables already in ``out_dir``. Columns
    beyond the declared ones pass through to the inspections. The counters
    report the dropped rows (C15), the establishments (C14), and the totals and
    statistics of the signals (V8, V9).
    """
    if mode == "explore" or out_dir is None:
        inspections = parse_violations(clean(raw, cfg), cfg=cfg)
    if mode == "explore":
        return TransformResult(inspections, None, explore_report(explore_sample(inspections)))
    if out_dir is None:
        return TransformResult(inspections, risk_scores(inspections, as_of, cfg))
    base = out_dir.rstrip("/")
    repeated = repeated_ids(usable_records(raw, cfg)) if "inspection_id" in raw.columns else None
    observed, obs = _observed(raw, cfg)
    inspections = parse_violations(clean(observed, cfg, repeated), cfg=cfg)
    counters: dict = {}

    def write_both(path: str) -> None:
        write_parquet(inspections.drop("kw_found", LANDING), path)
        stored = spark.read.parquet(path)
        if "inspection_id" in raw.columns:
            require_key(stored.filter(F.col("inspection_id").isNotNull()), "inspection_id", "inspections")
        counters.update(obs.get)
        report = signal_report(stored).first().asDict()
        counters["duplicates"] = counters["remaining"] - report.pop("n_rows")
        counters.update(report)

        def write_scores(scores_path: str) -> None:
            clustered_scores(risk_scores(stored, as_of, cfg), scores_path)
            # one row per establishment, so the key check's count is theirs (C14)
            counters["n_establishments"] = require_key_count(spark.read.parquet(scores_path), "establishment_id", "risk_scores")

        switch_in(spark, f"{base}/risk_scores", write_scores)

    switch_in(spark, f"{base}/inspections", write_both)
    return TransformResult(spark.read.parquet(f"{base}/inspections"), spark.read.parquet(f"{base}/risk_scores"),
                           counters=counters)
