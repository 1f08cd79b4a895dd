"""One stored rollup of the scores that feeds every panel.

``score_rollup`` keeps one row per ZIP, facility type and score with counts and
exact sums. Scores have one decimal in 0..100, so its size follows the number of
(ZIP, type) pairs, not of establishments. All of its measures add up, so rollups
of parts of the table merge (``merge``), and every sidebar filter (D2, D3) still
applies to it, since the filtered columns are its keys.

``panel_sums`` makes one pass over the filtered rollup with grouping sets: the
total, each score, each facility type and each ZIP. The panels read that small result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import HIGH_RISK
from ..functions.numeric import round1, scaled
from .serving import KEY, SCORE, histogram_of_counts

DIMENSIONS = ["zip", "facility_type", SCORE]
MEASURES = ["establishments", "keyed", "total_failures", "total_inspections"]
# grouping_id of each set: a bit per dimension that the set leaves out, the first dimension highest
BY_ZIP, BY_TYPE, BY_SCORE, TOTAL = 0b011, 0b101, 0b110, 0b111


def score_rollup(scores: DataFrame) -> DataFrame:
    """Counts and sums per ZIP, facility type and score; nulls are keys like any other."""
    return scores.groupBy(*DIMENSIONS).agg(
        F.count(F.lit(1)).alias("establishments"), F.count(KEY).alias("keyed"),
        F.sum("total_failures").cast("long").alias("total_failures"),
        F.sum("total_inspections").cast("long").alias("total_inspections"))


def merge(*rollups: DataFrame) -> DataFrame:
    """The rollup of several tables' rows together, from each one's rollup."""
    first, *more = rollups
    for r in more:
        first = first.unionByName(r)
    return first.groupBy(*DIMENSIONS).agg(*(F.sum(m).alias(m) for m in MEASURES))


def panel_sums(filtered: DataFrame) -> DataFrame:
    """One pass over a (filtered) rollup: its sums in total, by score, by type and by ZIP.

    Partial sums before the shuffle make a ZIP with a large share of the rows as
    cheap as any other.
    """
    s, n = F.col(SCORE), F.col("establishments")
    # the sets null out the columns they leave out, so the score's own sums are taken from a copy
    own = filtered.withColumns({"_units": scaled(SCORE, 1) * n, "_scored": F.when(s.isNotNull(), n).otherwise(0),
                                "_high": F.when(s >= HIGH_RISK, n).otherwise(0)})
    sets = [[F.col("zip")], [F.col("facility_type")], [s], []]
    return own.groupingSets(sets, *DIMENSIONS).agg(
        F.grouping_id().cast("int").alias("grouped"), *(F.sum(m).alias(m) for m in MEASURES),
        F.sum("_units").alias("units"), F.sum("_scored").alias("scored"), F.sum("_high").alias("high_risk"))


def _mean() -> Column:
    """Mean score from its exact sum in tenths, as ``exact_mean`` takes it."""
    return F.col("units") / F.lit(10.0) / F.nullif(F.col("scored"), F.lit(0))


def kpis(sums: DataFrame) -> DataFrame:
    """D4. Sums of no rows at all give one row, as an aggregate does."""
    total = sums.where(F.col("grouped") == TOTAL)
    return total.agg(
        F.coalesce(F.sum("establishments"), F.lit(0)).alias("establishments"),
        F.coalesce(F.sum("high_risk"), F.lit(0)).alias("high_risk"),
        F.max(_mean()).alias("avg_risk_score"),
        F.sum("total_failures").alias("total_failures"), F.sum("total_inspections").alias("total_inspections"))


def score_histogram(sums: DataFrame, bins: int = 25) -> DataFrame:
    """D7 from the counts by score."""
    counts = sums.where((F.col("grouped") == BY_SCORE) & F.col(SCORE).isNotNull())
    return histogram_of_counts(counts.select(F.col(SCORE).alias("s"), F.col("establishments").alias("n")), bins)


def risk_by_facility(sums: DataFrame, min_n: int = 10, k: int = 15) -> DataFrame:
    """D8."""
    rows = sums.where((F.col("grouped") == BY_TYPE) & F.col("facility_type").isNotNull() & (F.col("scored") >= min_n))
    return (rows.select("facility_type", _mean().alias("avg_risk"), F.col("scored").alias("n"))
            .orderBy(F.col("avg_risk").desc(), "facility_type").limit(k))


def risk_by_zip(sums: DataFrame, min_n: int = 5) -> DataFrame:
    """D16."""
    rows = sums.where((F.col("grouped") == BY_ZIP) & F.col("zip").isNotNull() & (F.col("keyed") >= min_n))
    return rows.select("zip", _mean().alias("avg_risk"), F.col("keyed").alias("n_establishments"), "high_risk")


def zip_chart(sums: DataFrame, k: int = 20) -> DataFrame:
    """D18."""
    return risk_by_zip(sums).orderBy(F.col("avg_risk").desc(), "zip").limit(k)


def zip_table(sums: DataFrame, k: int = 15) -> DataFrame:
    """D17."""
    return zip_chart(sums, k).select(
        F.col("zip").alias("ZIP"), round1("avg_risk").alias("Avg Risk"),
        F.col("n_establishments").alias("Establishments"), F.col("high_risk").alias("High Risk (>=70)"))


def panels(sums: DataFrame) -> dict[str, DataFrame]:
    """Every panel that counts or averages, from the sums of one pass."""
    return {"kpis": kpis(sums), "histogram": score_histogram(sums), "by_facility": risk_by_facility(sums),
            "zip_table": zip_table(sums), "zip_chart": zip_chart(sums)}
