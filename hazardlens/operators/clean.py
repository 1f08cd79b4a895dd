"""Cleaning (C1-C15): parse, filter, normalise, dedup, establishment key.

Everything is narrow except the dedup (C6), which keeps, per id, the copy landed
last. It is one hash exchange on ``inspection_id``: a group limit with a partial
(map-side) step, so a hot id — e.g. one record re-sent millions of times — is
reduced to one row per map task before the shuffle. Over stored records
(``dedup_late``) only ids and landing order are shuffled, and the few superseded
rows are dropped in the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoringConfig
from ..functions.text import norm, safe_double, safe_timestamp, strip
from ..schemas import BATCH, LANDING, RAW, RAW_REQUIRED, ensure_columns
from ..session import drop_staged_frame, staged

KEY_SEPARATOR = "|"
REPEATED_IDS = 500_000        # ids with several records up to which they are sent to every task (about 50 MB)


def result_score(results_norm: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """Normalised result -> 0 / 0.5 / 1 (null for anything unusable)."""
    expr = None
    for k, v in cfg.result_scores.items():
        if v is None:
            continue
        expr = F.when(results_norm == k, F.lit(v)) if expr is None else expr.when(results_norm == k, F.lit(v))
    return expr


def parse_dates(raw: DataFrame) -> DataFrame:
    """``inspection_date`` text -> TIMESTAMP_NTZ (bad -> null)."""
    return raw.withColumn("inspection_date", safe_timestamp("inspection_date"))


def drop_bad_dates(df: DataFrame) -> DataFrame:
    """Keep rows whose date parsed."""
    return df.filter(F.col("inspection_date").isNotNull())


def normalize_results(df: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """C3 + C4 + C5: strip/lower results, keep usable ones, map to a score."""
    df = df.withColumn("results", norm("results"))
    df = df.filter(F.col("results").isin(cfg.usable_results))
    return df.withColumn("result_score", result_score(F.col("results"), cfg))


def landing_columns(df: DataFrame) -> list[str]:
    """The columns that order records as they landed, the weightiest first."""
    own = [c for c in (BATCH, LANDING) if c in df.columns]
    return own if LANDING in own else [*own, "ingest_seq"]


def _known_order(df: DataFrame, order: list[str] | None) -> list[Column]:
    """The order columns, weightiest first; a null in one raises when it is read."""
    out = []
    for c in order or landing_columns(df):
        refused = F.raise_error(F.lit(f"keep-last dedup: {c} is null, so the landing order is unknown"))
        out.append(F.when(F.col(c).isNull(), refused.cast(df.schema[c].dataType)).otherwise(F.col(c)))
    return out


def _one_order(df: DataFrame, order: list[str] | None) -> Column:
    """The order as one value: a single column as it is, several as a struct."""
    by = _known_order(df, order)
    return by[0] if len(by) == 1 else F.struct(*(c.alias(f"c{i}") for i, c in enumerate(by)))


def dedup_keep_last(df: DataFrame, key: str = "inspection_id", order: list[str] | None = None) -> DataFrame:
    """One row per ``key``, the last landed. Null keys form one group.

    ``order`` (by default the reader's landing order, else ``ingest_seq``)
    must be unique within a key; a null in it raises, since the last of
    records that landed in no order is undefined. Planned as a group limit of
    one: each map task sends one row per key at most, and columns that nobody
    reads are pruned below it.
    """
    if key not in df.columns:
        return df
    by = [c.desc() for c in _known_order(df, order)]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*by))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= 1).drop("_rank")


def repeated_ids(df: DataFrame, key: str = "inspection_id", order: list[str] | None = None) -> DataFrame | None:
    """The keys that more than one row holds, with the order of the last one (``_last``).

    Only the key and the order columns are read and shuffled, one row per key and
    map task. The result is written to the shared folder and counted: beyond
    ``REPEATED_IDS`` rows it is not returned, since it is meant to be sent to
    every task.
    """
    last = F.max(_one_order(df, order))
    found = (df.groupBy(F.col(key).alias("_repeated")).agg(last.alias("_last"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1").select("_repeated", "_last"))
    found = staged(found, "repeated-ids")
    if found.count() <= REPEATED_IDS:
        return found
    drop_staged_frame(found)
    return None


def drop_repeated(df: DataFrame, repeated: DataFrame, key: str = "inspection_id", order: list[str] | None = None) -> DataFrame:
    """C6 by ``repeated_ids``: the rows of its keys that landed before the last one
    go, in the scan itself; no row of ``df`` is shuffled."""
    placed = df.withColumn("_own", _one_order(df, order))
    gone = placed[key].eqNullSafe(repeated["_repeated"]) & (placed["_own"] < repeated["_last"])
    return placed.join(F.broadcast(repeated), gone, "left_anti").drop("_own")


def dedup_late(df: DataFrame, key: str = "inspection_id", order: list[str] | None = None) -> DataFrame:
    """C6 without shipping whole rows: reads the narrow columns first and then drops
    the few superseded rows where they are read. With more repeated keys than
    can be sent to every task, ``dedup_keep_last``.

    For sources that can be read twice cheaply (stored tables and files)."""
    if key not in df.columns:
        return df
    repeated = repeated_ids(df, key, order)
    return dedup_keep_last(df, key, order) if repeated is None else drop_repeated(df, repeated, key, order)


def normalize_text(df: DataFrame) -> DataFrame:
    """C7 + C8 + C9: inspection type to key form; names/address/optional text stripped."""
    df = ensure_columns(df, RAW)
    return df.withColumns({
        "inspection_type": norm("inspection_type"),
        "dba_name": strip("dba_name"),
        "aka_name": strip("aka_name"),
        "address": strip("address"),
        "facility_type": strip("facility_type"),
        "risk": strip("risk"),
        "zip": strip("zip"),
    })


def fill_violations(df: DataFrame) -> DataFrame:
    """Null violation text -> empty string."""
    return df.withColumn("violations", F.coalesce(F.col("violations"), F.lit("")))


def safe_coordinates(df: DataFrame) -> DataFrame:
    """C11: latitude / longitude text -> double, bad -> null."""
    return df.withColumns({"latitude": safe_double("latitude"), "longitude": safe_double("longitude")})


def establishment_key(df: DataFrame) -> DataFrame:
    """C12 + C13: stripped licence, or ``lower(name)|lower(address)`` when it is null/blank."""
    lic = strip("license_")
    return df.withColumn("license_", lic).withColumn(
        "establishment_id", _key_expr(F.col("license_"), F.col("dba_name"), F.col("address")))


def require_columns(raw: DataFrame) -> None:
    """The published cleaning reads these columns without a guard: fail early if absent."""
    missing = [c for c in RAW_REQUIRED if c not in raw.columns]
    if missing:
        raise ValueError(f"raw records lack required column(s): {', '.join(missing)}")


def _key_expr(license_stripped: Column, name: Column, address: Column) -> Column:
    fallback = F.concat(F.lower(F.coalesce(name, F.lit(""))), F.lit(KEY_SEPARATOR),
                        F.lower(F.coalesce(address, F.lit(""))))
    return F.when(F.length(license_stripped) > 0, license_stripped).otherwise(fallback)


def usable_records(raw: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """C1 -> C5: records whose date parses and whose result counts, with its score."""
    require_columns(raw)
    df = ensure_columns(raw, RAW)
    others = [c for c in df.columns if c not in ("inspection_date", "results")]
    parsed = df.select(*others, safe_timestamp("inspection_date").alias("inspection_date"),
                       norm("results").alias("results"))
    return (parsed.filter(F.col("inspection_date").isNotNull() & F.col("results").isin(cfg.usable_results))
            .withColumn("result_score", result_score(F.col("results"), cfg))
            .select(*df.columns, "result_score"))


def clean(raw: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG, repeated: DataFrame | None = None) -> DataFrame:
    """The whole cleaning step with the published semantics (C1 -> C13).

    Same expressions as the step functions above, fused into three
    projections so the plan stays small: filter + score before the dedup
    (rows that can never survive are dropped before they are shuffled), then one
    projection for all row-wise normalisation. ``repeated`` are the
    ``repeated_ids`` of the usable records, if known: the dedup then shuffles nothing.
    """
    has_id = "inspection_id" in raw.columns     # the dedup is skipped when there is no id column
    usable = usable_records(raw, cfg)
    if has_id:
        d = dedup_keep_last(usable) if repeated is None else drop_repeated(usable, repeated)
    else:
        d = usable
    lic = strip("license_")
    name, addr = strip("dba_name"), strip("address")
    replaced = {
        "inspection_type": norm("inspection_type"),
        "dba_name": name, "aka_name": strip("aka_name"), "address": addr,
        "facility_type": strip("facility_type"), "risk": strip("risk"), "zip": strip("zip"),
        "violations": F.coalesce(F.col("violations"), F.lit("")),
        "latitude": safe_double("latitude"), "longitude": safe_double("longitude"),
        "license_": lic,
    }
    cols = [replaced[c].alias(c) if c in replaced else F.col(c) for c in d.columns]
    return d.select(*cols, _key_expr(lic, name, addr).alias("establishment_id"))


def count_establishments(cleaned: DataFrame, approximate: bool = False) -> DataFrame:
    """C14: distinct establishment keys (exact, or HyperLogLog++ at scale)."""
    agg = (F.approx_count_distinct("establishment_id") if approximate
           else F.count_distinct("establishment_id"))
    return cleaned.agg(agg.alias("n_establishments"))


def clean_report(raw: DataFrame, cfg: ScoringConfig = DEFAULT_CONFIG) -> DataFrame:
    """Row-drop accounting as (metric, n) rows.

    bad_dates / unusable_results / remaining come from one pass over the raw
    rows; duplicates = remaining - distinct ids after the filters.
    """
    has_id = "inspection_id" in raw.columns
    df = ensure_columns(raw, RAW)
    d = safe_timestamp("inspection_date")
    r = norm("results")
    usable = r.isin(cfg.usable_results) & r.isNotNull()
    stats = df.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(d.isNull()).alias("bad_dates"),
        F.count_if(d.isNotNull() & ~F.coalesce(usable, F.lit(False))).alias("unusable_results"),
        F.count_if(d.isNotNull() & F.coalesce(usable, F.lit(False))).alias("remaining"),
        F.count_distinct(F.when(d.isNotNull() & F.coalesce(usable, F.lit(False)),
                                F.coalesce(F.col("inspection_id"), F.lit("\u0000null")))).alias("_distinct"),
    ).withColumn("duplicates", F.col("remaining") - F.col("_distinct") if has_id else F.lit(0).cast("long"))
    metrics = ["raw_rows", "bad_dates", "unusable_results", "remaining", "duplicates"]
    stacked = ", ".join(f"'{m}', {m}" for m in metrics)
    return stats.selectExpr(f"stack({len(metrics)}, {stacked}) AS (metric, n)")
