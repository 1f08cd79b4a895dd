"""Query registry: one Spark query + one oracle SQL per inventory operator.

Every query reads the driver's tables under ``sf_dir`` (through the derived
raw-inspections input) and runs over whole tables. Queries that exercise a
sink or a file source write to a fresh folder under the session's shared
checkpoint directory and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_CONFIG
from ..functions import violations as V
from ..operators import clean as C
from ..operators import explore as X
from ..operators import profiling as P
from ..operators import rollup as RU
from ..operators import scoring as R
from ..operators import search_index as SI
from ..operators import serving as D
from ..operators.signals import parse_violations, severity_stats, signal_totals
from ..functions.numeric import clamp, round1
from ..schemas import INSPECTION_COLUMNS, INSPECTIONS, RAW, RAW_TEXT_COLUMNS, SCORES, to_sink_schema
from ..session import COMPACT, drop_staged, shuffles_dropped, staged, staging_path
from ..sinks import layout as LY
from ..sinks import snapshots as SN
from ..sinks import writers as K
from ..sources import files as SF
from ..sources import landed as L
from ..sources.fixtures import documents_text, raw_inspections
from ..streaming.refresh import latest_output, start_refresh
from . import oracle as O
from .batch import run_transform

AS_OF = O.AS_OF
AS_OF_PAST = "2000-01-01 00:00:00"   # second clock: failures after it give negative day counts
PAGE_SIZE_TEST = 5_000
CSV_FILE_RECORDS = 50_000            # records to a landed CSV file, about 20 MB
# Dashboard parameters used by the registered serving queries.
RANGE_LO, RANGE_HI = 40.0, 60.0
SELECT_TYPES = ("BUILDING", "MACHINERY")
SELECT_ZIPS = ("60601", "60607", "60610")
SEARCH_TERM = "customer#0000011"
TOP_N = 20

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None, as_of: str = AS_OF):
    def deco(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _SQL[name] = O.with_chain(sql, as_of)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# ---------------------------------------------------------------- shared plans

def _raw(spark, sf):
    return raw_inspections(spark, sf)


def _raw_once(spark, sf):
    """The raw records derived once and stored, for queries that read them several times."""
    return staged(_raw(spark, sf), "raw")


def _clean(spark, sf):
    return C.clean(_raw(spark, sf))


def _insp(spark, sf):
    return parse_violations(_clean(spark, sf))


def _insp_once(spark, sf):
    """The inspections table stored once, as the batch job does: the texts are parsed
    and the records deduplicated one time for all that reads them."""
    return staged(_insp(spark, sf).select(INSPECTION_COLUMNS), "inspections")


def _comp(spark, sf):
    return R.components(_insp(spark, sf), AS_OF)


def _scores(spark, sf):
    return R.risk_scores(_insp(spark, sf), AS_OF)


def _matches(spark, sf):
    return D.search_top(_scores(spark, sf), SEARCH_TERM, TOP_N)


def _flat(df: DataFrame) -> DataFrame:
    """Array columns joined to text, for engine-neutral comparison."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType):
            cols.append(F.array_join(F.col(f.name), ",").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(cols)


RAW_COLS = ", ".join(RAW.fieldNames())
INSP_COLS = ", ".join(INSPECTION_COLUMNS)
SCORE_COLS = ", ".join(SCORES.fieldNames())
FLAT_SIGNALS = ("* REPLACE (array_to_string(violation_codes, ',') AS violation_codes, "
                "array_to_string(kw_found, ',') AS kw_found)")
_FLOAT_INSP = {"result_score", "violation_severity", "latitude", "longitude"}
_FLOAT_SCORES = {"latitude", "longitude", "failure_rate_score", "recency_score",
                 "violation_severity_score", "trend_score", "dynamic_risk_score"}


def _sink_cols(cols: list[str], floats: set[str]) -> str:
    return ", ".join(f"CAST({c} AS FLOAT) AS {c}" if c in floats else c for c in cols)


# ---------------------------------------------------------------- S: sources

@register("page_scan", f"SELECT {RAW_COLS} FROM raw_inspections")
def page_scan(spark, sf):
    path = L.land_pages(_raw_once(spark, sf), staging_path(spark, "pages"), PAGE_SIZE_TEST)
    return L.read_pages(spark, path, L.page_schema(with_seq=True)).select(RAW.fieldNames())


@register("union_pages", f"SELECT * REPLACE (CASE WHEN ingest_seq = 1 THEN NULL ELSE aka_name END AS aka_name) "
                         f"FROM (SELECT {RAW_COLS} FROM raw_inspections)")
def union_pages(spark, sf):
    raw = _raw_once(spark, sf)
    first = L.land_pages(raw.filter("ingest_seq = 0"), staging_path(spark, "pages-a"), PAGE_SIZE_TEST)
    later_cols = [c for c in raw.columns if c != "aka_name"]
    second = L.land_pages(raw.filter("ingest_seq = 1"), staging_path(spark, "pages-b"), PAGE_SIZE_TEST, later_cols)
    narrow = T.StructType([f for f in RAW.fields if f.name != "aka_name"])
    parts = [L.read_pages(spark, first, L.page_schema(with_seq=True)), L.read_pages(spark, second, narrow)]
    return L.union_pages(parts).select(RAW.fieldNames())


def _unsorted_drops(spark, sf, name, write):
    """The records in two drops of unequal size, without their order in the data:
    the first copies, then the later ones, each in several files."""
    raw, path = _raw_once(spark, sf), staging_path(spark, name)
    for drop, seq in (("drop1", 0), ("drop2", 1)):
        write(raw.filter(F.col("ingest_seq") == seq), f"{path}/{drop}")
    return path


@register("dedup_landed_pages", "SELECT inspection_id, results, result_score FROM c_dedup")
def dedup_landed_pages(spark, sf):
    """S2 + C6 on real pages: the landing order is that of the files and lines."""
    path = _unsorted_drops(spark, sf, "dedup-pages", lambda df, to: L.land_pages(df, to, PAGE_SIZE_TEST, RAW_TEXT_COLUMNS))
    raw = L.read_pages(spark, [f"{path}/drop1", f"{path}/drop2"])
    df = C.dedup_keep_last(C.normalize_results(C.drop_bad_dates(C.parse_dates(raw))))
    return df.select("inspection_id", "results", "result_score")


@register("dedup_numbered_pages", "SELECT inspection_id, results, result_score FROM c_dedup")
def dedup_numbered_pages(spark, sf):
    """S1 + C6 on pages numbered without leading zeros: 9, then 10 and 11 with the copies sent later."""
    raw, path = _raw_once(spark, sf), staging_path(spark, "numbered")
    later = F.col("ingest_seq") == 1
    even = F.crc32("inspection_id") % 2 == 0
    for page, part in ((9, ~later), (10, later & even), (11, later & ~even)):
        L.land_pages(raw.filter(part), f"{path}/page_{page}", PAGE_SIZE_TEST, RAW_TEXT_COLUMNS)
    df = C.normalize_results(C.drop_bad_dates(C.parse_dates(L.read_pages(spark, f"{path}/*"))))
    return C.dedup_keep_last(df).select("inspection_id", "results", "result_score")


@register("dedup_by_manifest", "SELECT inspection_id, results, result_score FROM c_dedup")
def dedup_by_manifest(spark, sf):
    """S1 + C6 where names give no order: the copies sent later land under a name that
    sorts first, and the folder's manifest tells when each file arrived."""
    raw, path = _raw_once(spark, sf), staging_path(spark, "manifest")
    for name, seq in (("z-first", 0), ("a-later", 1)):
        some = raw.filter(F.col("ingest_seq") == seq).select(*RAW_TEXT_COLUMNS)
        some.withColumn("pull", F.lit(name)).write.mode("append").partitionBy("pull").json(path)
        L.record_landing(spark, path)
    df = C.normalize_results(C.drop_bad_dates(C.parse_dates(L.read_pages(spark, path))))
    return C.dedup_keep_last(df).select("inspection_id", "results", "result_score")


CLASHING = {"Zip": "zip", "landing": "facility_type", "result_score": "results", "establishment_id": "license_", "ward": "risk"}


@register("clashing_keys", f"SELECT {', '.join(RAW_TEXT_COLUMNS)}, ingest_seq, zip AS Zip_landed, facility_type AS landing_landed, "
                           "results AS result_score_landed, license_ AS establishment_id_landed, risk AS ward FROM raw_inspections")
def clashing_keys(spark, sf):
    """One record per line, with keys that equal columns of later steps, or declared
    ones but for case, and one new key; all come back."""
    raw, path = _raw(spark, sf), staging_path(spark, "clashing")
    entries = {**{c: c for c in RAW.fieldNames()}, **CLASHING}
    record = F.create_map(*(x for key, c in entries.items() for x in (F.lit(key), F.col(c).cast("string"))))
    raw.select(F.to_json(record).alias("value")).write.text(path)
    df = L.read_all_keys(spark, path)
    return df.drop("landing").withColumnRenamed("ingest_seq_landed", "ingest_seq").withColumn("ingest_seq", F.col("ingest_seq").cast("long"))


@register("dedup_csv_files", "SELECT inspection_id, results, result_score FROM c_dedup")
def dedup_csv_files(spark, sf):
    """S4 + C6 over several CSV files: the landing order is that of the files and rows.

    A multi-line file is read by one task, so more records mean more files, not larger ones."""
    path = _unsorted_drops(spark, sf, "dedup-csv",
                           lambda df, to: K.write_csv(df.select(RAW_TEXT_COLUMNS), to, max_records=CSV_FILE_RECORDS))
    raw = SF.read_raw_csv(spark, f"{path}/*", null_value=SF.CSV_OPTIONS["nullValue"])
    df = C.dedup_keep_last(C.normalize_results(C.drop_bad_dates(C.parse_dates(raw))))
    return df.select("inspection_id", "results", "result_score")


@register("ordered_page", f"""SELECT inspection_id, ingest_seq FROM raw_inspections
ORDER BY inspection_id NULLS FIRST, ingest_seq NULLS FIRST LIMIT {PAGE_SIZE_TEST} OFFSET {PAGE_SIZE_TEST}""")
def ordered_page(spark, sf):
    path = L.store_pages(_raw(spark, sf), staging_path(spark, "paged"), PAGE_SIZE_TEST)
    return L.stored_page(spark, path, 1).select("inspection_id", "ingest_seq")


@register("page_assignment", f"""SELECT CAST(floor(rn / {PAGE_SIZE_TEST}) AS BIGINT) AS page_no, count(*) AS n_rows,
  min(rn) AS first_row, max(rn) AS last_row
FROM (SELECT row_number() OVER (ORDER BY inspection_id NULLS FIRST, ingest_seq NULLS FIRST) - 1 AS rn FROM raw_inspections)
GROUP BY 1""")
def page_assignment(spark, sf):
    return L.page_summary(L.assign_pages(_raw(spark, sf), PAGE_SIZE_TEST))


@register("csv_raw_round_trip", f"SELECT {RAW_COLS} FROM raw_inspections")
def csv_raw_round_trip(spark, sf):
    path = staging_path(spark, "raw-csv")
    K.write_csv(_raw(spark, sf), path)
    return SF.read_csv(spark, path, RAW)


@register("csv_inspections_round_trip", f"SELECT {INSP_COLS} FROM inspections")
def csv_inspections_round_trip(spark, sf):
    path = staging_path(spark, "inspections-csv")
    K.write_csv(_insp(spark, sf).drop("kw_found").select(INSPECTION_COLUMNS), path)
    return SF.read_csv(spark, path, INSPECTIONS)


@register("csv_scores_round_trip", f"SELECT {SCORE_COLS} FROM risk_scores")
def csv_scores_round_trip(spark, sf):
    path = staging_path(spark, "scores-csv")
    K.write_csv(_scores(spark, sf), path)
    return SF.read_csv(spark, path, SCORES)


@register("table_scan", f"SELECT {SCORE_COLS} FROM risk_scores")
def table_scan(spark, sf):
    path = staging_path(spark, "scores-table")
    K.write_parquet(_scores(spark, sf), path)
    return spark.read.parquet(path)


@register("inspections_scan", f"SELECT {', '.join(D.INSPECTION_VIEW_COLUMNS)} FROM inspections")
def inspections_scan(spark, sf):
    path = staging_path(spark, "inspections-table")
    K.write_parquet(_insp(spark, sf).drop("kw_found"), path)
    return D.inspections_view(spark.read.parquet(path))


@register("source_fallback", f"SELECT {SCORE_COLS} FROM risk_scores")
def source_fallback(spark, sf):
    path = staging_path(spark, "scores-fallback")
    K.write_parquet(_scores(spark, sf), path)
    return SF.table_or_path(spark, "hazardlens_scores_not_registered", path, SCORES)


@register("source_catalog", f"SELECT {SCORE_COLS} FROM risk_scores")
def source_catalog(spark, sf):
    """S9, the catalog branch: a registered table goes before files."""
    import uuid
    name = f"hazardlens_scores_{uuid.uuid4().hex[:8]}"
    _scores(spark, sf).write.option("path", staging_path(spark, "scores-table")).saveAsTable(name)
    return SF.table_or_path(spark, name, "/no/such/path", SCORES)


@register("reparse_dates", "SELECT establishment_id, last_inspection_date FROM risk_scores")
def reparse_dates(spark, sf):
    path = staging_path(spark, "scores-text")
    K.write_csv(_scores(spark, sf), path)
    text = T.StructType([T.StructField(c, T.StringType()) for c in SCORES.fieldNames()])
    return SF.reparse_dates(SF.read_csv(spark, path, text), ["last_inspection_date"]) \
        .select("establishment_id", "last_inspection_date")


# ---------------------------------------------------------------- K: sinks

@register("refresh_tables", """SELECT 'inspections' AS table_name, count(*) AS n_rows FROM inspections
UNION ALL SELECT 'risk_scores', count(*) FROM risk_scores""")
def refresh_tables(spark, sf):
    ip, sp = staging_path(spark, "t-insp"), staging_path(spark, "t-scores")
    insp = _insp_once(spark, sf)
    K.refresh_tables(insp, R.risk_scores(insp, AS_OF), ip, sp)
    return P.verify_counts(spark.read.parquet(ip), spark.read.parquet(sp))


_HALF = "1995-01-01"


@register("refresh_snapshots", f"""SELECT 'before' AS reader, count(*) AS n_inspections, count(DISTINCT establishment_id) AS n_scores
FROM inspections WHERE inspection_date < TIMESTAMP '{_HALF}'
UNION ALL SELECT 'after', count(*), count(DISTINCT establishment_id) FROM inspections""")
def refresh_snapshots(spark, sf):
    """One reader holds the tables from before a refresh, one takes those of after it."""
    base, insp = staging_path(spark, "snapshots"), _insp_once(spark, sf)
    counts = []
    for reader, rows in (("before", insp.filter(F.col("inspection_date") < F.lit(_HALF).cast("timestamp_ntz"))), ("after", insp)):
        SN.publish(rows, R.risk_scores(rows, AS_OF), base)
        held = SN.current(spark, base)
        tables = [held.read(spark, t).select(F.lit(own).alias("own")) for t, own in (("inspections", True), ("risk_scores", False))]
        rows = tables[0].unionByName(tables[1])
        counts.append(rows.agg(F.count_if("own").alias("n_inspections"), F.count_if(~F.col("own")).alias("n_scores"))
                      .select(F.lit(reader).alias("reader"), "n_inspections", "n_scores"))
    return counts[0].unionByName(counts[1])


@register("catalog_scan", f"SELECT {_sink_cols(SCORES.fieldNames(), _FLOAT_SCORES)} FROM risk_scores "
                          "WHERE establishment_id IS NOT NULL")
def catalog_scan(spark, sf):
    """K4 into catalog tables, then S7: ``SELECT * FROM risk_scores`` through the catalog."""
    import uuid
    suffix = uuid.uuid4().hex[:8]
    insp = _insp_once(spark, sf)
    K.refresh_catalog_tables(insp, R.risk_scores(insp, AS_OF), f"hazardlens_inspections_{suffix}",
                             f"hazardlens_risk_scores_{suffix}", staging_path(spark, "catalog"))
    return spark.table(f"hazardlens_risk_scores_{suffix}")


@register("load_inspections", f"SELECT {_sink_cols(INSPECTION_COLUMNS, _FLOAT_INSP)} FROM inspections")
def load_inspections(spark, sf):
    path = staging_path(spark, "load-insp")
    K.append_table(K.inspections_for_load(_insp(spark, sf)), path)
    return spark.read.parquet(path)


@register("load_scores", f"SELECT {_sink_cols(SCORES.fieldNames(), _FLOAT_SCORES)} FROM risk_scores "
                         "WHERE establishment_id IS NOT NULL")
def load_scores(spark, sf):
    path = staging_path(spark, "load-scores")
    K.append_table(K.scores_for_load(_scores(spark, sf)), path)
    return spark.read.parquet(path)


_KEY_SQL = """SELECT '{t}' AS table_name, CAST(sum(c) AS BIGINT) AS n_rows, count({k}) AS distinct_keys,
  CAST(coalesce(sum(CASE WHEN {k} IS NULL THEN c END), 0) AS BIGINT) AS null_keys,
  count(*) FILTER (WHERE {k} IS NOT NULL AND c > 1) AS duplicate_keys
FROM (SELECT {k}, count(*) AS c FROM {t} GROUP BY {k})"""


@register("key_check", _KEY_SQL.format(t="inspections", k="inspection_id") + "\nUNION ALL\n"
          + _KEY_SQL.format(t="risk_scores", k="establishment_id"))
def key_check(spark, sf):
    insp = _insp(spark, sf)
    return P.key_check(insp, "inspection_id", "inspections").unionByName(
        P.key_check(R.risk_scores(insp, AS_OF), "establishment_id", "risk_scores"))


@register("clustered_write", f"SELECT {SCORE_COLS} FROM risk_scores")
def clustered_write(spark, sf):
    path = staging_path(spark, "scores-clustered")
    K.clustered_scores(_scores(spark, sf), path)
    return spark.read.parquet(path)


@register("sink_schema", f"SELECT {_sink_cols(SCORES.fieldNames(), _FLOAT_SCORES)} FROM risk_scores")
def sink_schema(spark, sf):
    return to_sink_schema(_scores(spark, sf))


# ---------------------------------------------------------------- C: cleaning

@register("clean_dates", "SELECT inspection_id, ingest_seq, inspection_date FROM c_valid")
def clean_dates(spark, sf):
    return C.drop_bad_dates(C.parse_dates(_raw(spark, sf))).select("inspection_id", "ingest_seq", "inspection_date")


@register("clean_results", "SELECT inspection_id, ingest_seq, results, result_score FROM c_usable")
def clean_results(spark, sf):
    df = C.normalize_results(C.drop_bad_dates(C.parse_dates(_raw(spark, sf))))
    return df.select("inspection_id", "ingest_seq", "results", "result_score")


@register("dedup_inspections", "SELECT inspection_id, ingest_seq, results, result_score FROM c_dedup")
def dedup_inspections(spark, sf):
    """C6 by late materialisation: ids and order first, then the superseded rows go in the scan."""
    df = C.dedup_late(C.normalize_results(C.drop_bad_dates(C.parse_dates(_raw(spark, sf)))))
    return df.select("inspection_id", "ingest_seq", "results", "result_score")


@register("normalize_text", "SELECT inspection_id, inspection_type, dba_name, aka_name, address, "
                            "facility_type, risk, zip FROM cleaned")
def normalize_text(spark, sf):
    return _clean(spark, sf).select("inspection_id", "inspection_type", "dba_name", "aka_name", "address",
                                    "facility_type", "risk", "zip")


@register("fill_violations", "SELECT inspection_id, violations FROM cleaned")
def fill_violations(spark, sf):
    return _clean(spark, sf).select("inspection_id", "violations")


@register("safe_coordinates", "SELECT inspection_id, latitude, longitude FROM cleaned")
def safe_coordinates(spark, sf):
    return _clean(spark, sf).select("inspection_id", "latitude", "longitude")


@register("establishment_key", "SELECT inspection_id, license_, establishment_id FROM cleaned")
def establishment_key(spark, sf):
    return _clean(spark, sf).select("inspection_id", "license_", "establishment_id")


@register("count_establishments", "SELECT count(DISTINCT establishment_id) AS n_establishments FROM cleaned")
def count_establishments(spark, sf):
    return C.count_establishments(_clean(spark, sf))


@register("clean_report", """SELECT 'raw_rows' AS metric, (SELECT count(*) FROM raw_inspections) AS n
UNION ALL SELECT 'bad_dates', (SELECT count(*) FROM c_dates WHERE inspection_date IS NULL)
UNION ALL SELECT 'unusable_results', (SELECT count(*) FROM c_results WHERE results IS NULL OR results NOT IN ('pass', 'pass w/ conditions', 'fail'))
UNION ALL SELECT 'remaining', (SELECT count(*) FROM c_usable)
UNION ALL SELECT 'duplicates', (SELECT count(*) - count(DISTINCT coalesce(inspection_id, chr(0) || 'null')) FROM c_usable)""")
def clean_report(spark, sf):
    return C.clean_report(_raw(spark, sf))


# ---------------------------------------------------------------- Q: profiling

@register("raw_shape", f"SELECT count(*) AS n_rows, CAST({len(RAW.fields)} AS INTEGER) AS n_columns, "
                       f"'{','.join(RAW.fieldNames())}' AS columns FROM raw_inspections")
def raw_shape(spark, sf):
    return P.raw_shape(_raw(spark, sf))


@register("raw_date_range", "SELECT min(inspection_date) AS min_date_text, max(inspection_date) AS max_date_text "
                            "FROM raw_inspections")
def raw_date_range(spark, sf):
    return P.raw_date_range(_raw(spark, sf))


@register("distinct_licenses", "SELECT count(DISTINCT license_) AS n_licenses FROM raw_inspections")
def distinct_licenses(spark, sf):
    return P.distinct_licenses(_raw(spark, sf))


@register("result_distribution", "SELECT results, count(*) AS n FROM raw_inspections WHERE results IS NOT NULL "
                                 "GROUP BY results ORDER BY n DESC, results")
def result_distribution(spark, sf):
    return P.result_distribution(_raw(spark, sf))


# ---------------------------------------------------------------- V: text signals

@register("violation_codes", "SELECT inspection_id, array_to_string(violation_codes, ',') AS violation_codes "
                             "FROM inspections")
def violation_codes(spark, sf):
    return _flat(_insp(spark, sf).select("inspection_id", "violation_codes"))


@register("code_tiers", "SELECT inspection_id, n_critical, n_serious, n_minor FROM inspections")
def code_tiers(spark, sf):
    return _insp(spark, sf).select("inspection_id", "n_critical", "n_serious", "n_minor")


@register("keyword_scan", "SELECT inspection_id, kw_critical, kw_major, kw_minor, "
                          "array_to_string(kw_found, ',') AS kw_found FROM inspections")
def keyword_scan(spark, sf):
    return _flat(_insp(spark, sf).select("inspection_id", "kw_critical", "kw_major", "kw_minor", "kw_found"))


_DOC_KW = (f"SELECT doc_id, CAST(len(kc) AS INTEGER) AS kw_critical, CAST(len(km) AS INTEGER) AS kw_major, "
           f"CAST(len(kn) AS INTEGER) AS kw_minor, array_to_string(list_concat(list_concat(kc, km), kn), ',') AS kw_found "
           f"FROM (SELECT doc_id, {O.keyword_filter('critical', 'lt')} AS kc, {O.keyword_filter('major', 'lt')} AS km, "
           f"{O.keyword_filter('minor', 'lt')} AS kn FROM (SELECT doc_id, lower(coalesce(text, '')) AS lt FROM documents))")


@register("document_keywords", _DOC_KW)
def document_keywords(spark, sf):
    kw = V.keyword_scan("_places", DEFAULT_CONFIG)
    docs = documents_text(spark, sf).withColumn("_places", V.keyword_places(V.lowered_text("text"))).select(
        "doc_id", kw["critical"].alias("c"), kw["major"].alias("m"), kw["minor"].alias("n"))
    return docs.select("doc_id", F.size("c").alias("kw_critical"), F.size("m").alias("kw_major"),
                       F.size("n").alias("kw_minor"), F.array_join(F.concat("c", "m", "n"), ",").alias("kw_found"))


@register("structured_signal", "SELECT inspection_id, n_critical * CAST(3.0 AS DOUBLE) + n_serious * CAST(2.0 AS DOUBLE) "
                               "+ n_minor * CAST(1.0 AS DOUBLE) AS structured_signal FROM inspections")
def structured_signal(spark, sf):
    df = _insp(spark, sf)
    return df.select("inspection_id", V.structured_signal(F.col("n_critical"), F.col("n_serious"),
                                                          F.col("n_minor")).alias("structured_signal"))


@register("keyword_signal", "SELECT inspection_id, kw_critical * CAST(3.0 AS DOUBLE) + kw_major * CAST(2.0 AS DOUBLE) "
                            "+ kw_minor * CAST(1.0 AS DOUBLE) AS keyword_signal FROM inspections")
def keyword_signal(spark, sf):
    df = _insp(spark, sf)
    return df.select("inspection_id", V.keyword_signal(F.col("kw_critical"), F.col("kw_major"),
                                                       F.col("kw_minor")).alias("keyword_signal"))


@register("severity", "SELECT inspection_id, violation_severity FROM inspections")
def severity(spark, sf):
    return _insp(spark, sf).select("inspection_id", "violation_severity")


@register("parse_violations", f"SELECT {FLAT_SIGNALS} FROM inspections")
def parse_violations_q(spark, sf):
    return _flat(_insp(spark, sf))


@register("signal_totals", "SELECT CAST(coalesce(sum(len(violation_codes)), 0) AS BIGINT) AS total_codes, "
                           "CAST(coalesce(sum(len(kw_found)), 0) AS BIGINT) AS total_keyword_hits FROM inspections")
def signal_totals_q(spark, sf):
    return signal_totals(_insp(spark, sf))


@register("severity_stats", f"SELECT {O.round1(O.exact_mean('violation_severity', 2))} AS mean_severity, "
                            f"{O.round1(O.median('violation_severity'))} AS median_severity, "
                            f"{O.round1('max(violation_severity)')} AS max_severity FROM inspections")
def severity_stats_q(spark, sf):
    return severity_stats(_insp(spark, sf))


# ---------------------------------------------------------------- R: scoring

@register("type_weight", "SELECT inspection_id, inspection_type, CAST(type_weight AS DOUBLE) AS type_weight FROM sc_in")
def type_weight(spark, sf):
    df = R.scoring_input(_insp(spark, sf))
    return df.select("inspection_id", "inspection_type", F.col("type_weight").cast("double").alias("type_weight"))


@register("inspection_order", "SELECT inspection_id, establishment_id, CAST(recency_rank AS INTEGER) AS recency_rank "
                              "FROM sc_rank")
def inspection_order(spark, sf):
    return R.inspection_order(_insp(spark, sf)).select("inspection_id", "establishment_id", "recency_rank")


@register("failure_rate", f"SELECT establishment_id, weighted_failures, total_weight, "
                          f"{O.round1('failure_rate')} AS failure_rate_score FROM components")
def failure_rate(spark, sf):
    return _comp(spark, sf).select("establishment_id", "weighted_failures", "total_weight",
                                   round1("failure_rate").alias("failure_rate_score"))


@register("last_failure", "SELECT establishment_id, last_failure_date FROM components")
def last_failure(spark, sf):
    return _comp(spark, sf).select("establishment_id", "last_failure_date")


@register("recency", f"SELECT establishment_id, CAST(days_since_failure AS DOUBLE) AS days_since_failure, "
                     f"{O.round1('recency')} AS recency_score "
                     f"FROM components")
def recency(spark, sf):
    return _comp(spark, sf).select("establishment_id", F.col("days_since_failure").cast("double"),
                                   round1("recency").alias("recency_score"))


@register("recency_past", f"SELECT establishment_id, CAST(days_since_failure AS DOUBLE) AS days_since_failure, "
                          f"{O.round1('recency')} AS recency_score, {O.round1(f'greatest(0.0, least(100.0, composite))')} "
                          f"AS dynamic_risk_score FROM components", as_of=AS_OF_PAST)
def recency_past(spark, sf):
    """R6/R9 with the clock before the last inspections: negative days, recency above 100."""
    c = R.components(_insp(spark, sf), AS_OF_PAST)
    return c.select("establishment_id", F.col("days_since_failure").cast("double"),
                    round1("recency").alias("recency_score"),
                    round1(clamp(F.col("composite"), 0.0, 100.0)).alias("dynamic_risk_score"))


@register("mean_severity", f"SELECT establishment_id, severity AS severity_mean, "
                           f"{O.round1('severity')} AS violation_severity_score FROM components")
def mean_severity(spark, sf):
    return _comp(spark, sf).select("establishment_id", F.col("severity").alias("severity_mean"),
                                   round1("severity").alias("violation_severity_score"))


@register("trend", f"SELECT establishment_id, n, recent_avg, overall_avg, {O.round1('trend')} AS trend_score "
                   f"FROM components")
def trend(spark, sf):
    return _comp(spark, sf).select("establishment_id", "n", "recent_avg", "overall_avg",
                                   round1("trend").alias("trend_score"))


@register("composite", "SELECT establishment_id, dynamic_risk_score FROM risk_scores")
def composite(spark, sf):
    return _scores(spark, sf).select("establishment_id", "dynamic_risk_score")


@register("latest_inspection", "SELECT establishment_id, last_inspection_date, last_result, dba_name, aka_name, "
                               "address, zip, facility_type, risk_category, latitude, longitude FROM risk_scores")
def latest_inspection(spark, sf):
    return _scores(spark, sf).select("establishment_id", "last_inspection_date", "last_result", "dba_name",
                                     "aka_name", "address", "zip", "facility_type", "risk_category",
                                     "latitude", "longitude")


@register("outcome_counts", "SELECT establishment_id, total_inspections, total_failures, total_conditional, "
                            "total_passes FROM risk_scores")
def outcome_counts(spark, sf):
    return _scores(spark, sf).select("establishment_id", "total_inspections", "total_failures",
                                     "total_conditional", "total_passes")


@register("rounded_components", "SELECT establishment_id, failure_rate_score, recency_score, "
                                "violation_severity_score, trend_score FROM risk_scores")
def rounded_components(spark, sf):
    return _scores(spark, sf).select("establishment_id", "failure_rate_score", "recency_score",
                                     "violation_severity_score", "trend_score")


@register("risk_scores", f"SELECT {SCORE_COLS} FROM risk_scores")
def risk_scores_q(spark, sf):
    return _scores(spark, sf)


@register("score_distribution", f"""SELECT count(dynamic_risk_score) AS n,
  {O.round1(O.exact_mean('dynamic_risk_score', 1))} AS mean_score,
  {O.round1(O.median('dynamic_risk_score'))} AS median_score,
  {O.round1('stddev_samp(dynamic_risk_score)')} AS std_score,
  max(dynamic_risk_score) AS max_score FROM risk_scores""")
def score_distribution(spark, sf):
    return R.score_distribution(_scores(spark, sf))


@register("top10_riskiest", """SELECT establishment_id, dynamic_risk_score, substring(dba_name, 1, 40) AS dba_name,
  address FROM risk_scores ORDER BY dynamic_risk_score DESC NULLS LAST, establishment_id LIMIT 10""")
def top10_riskiest(spark, sf):
    return R.top_riskiest(_scores(spark, sf), 10)


# ---------------------------------------------------------------- L: load verification

@register("verify_counts", """SELECT 'inspections' AS table_name, count(*) AS n_rows FROM inspections
UNION ALL SELECT 'risk_scores', count(*) FROM risk_scores""")
def verify_counts(spark, sf):
    insp = _insp(spark, sf)
    return P.verify_counts(insp, R.risk_scores(insp, AS_OF))


@register("verify_top5", """SELECT establishment_id, dba_name, dynamic_risk_score FROM risk_scores
ORDER BY dynamic_risk_score DESC NULLS FIRST, establishment_id LIMIT 5""")
def verify_top5(spark, sf):
    return P.verify_top(_scores(spark, sf), 5)


# ---------------------------------------------------------------- D: serving

_SEARCH_WHERE = " OR ".join(f"coalesce(regexp_matches(lower({c}), '{SEARCH_TERM}'), false)"
                            for c in ("dba_name", "aka_name", "address"))
_MATCHES = (f"SELECT * FROM risk_scores WHERE {_SEARCH_WHERE} "
            f"ORDER BY dynamic_risk_score DESC NULLS LAST, establishment_id LIMIT {TOP_N}")
_RISK_BY_ZIP = (f"SELECT zip, {O.exact_mean('dynamic_risk_score', 1)} AS avg_risk, count(establishment_id) AS n_establishments, "
                f"count(*) FILTER (WHERE dynamic_risk_score >= {O.HIGH}) AS high_risk FROM risk_scores "
                f"WHERE zip IS NOT NULL GROUP BY zip HAVING count(establishment_id) >= 5")


@register("facets", """SELECT DISTINCT 'facility_type' AS facet, facility_type AS value FROM risk_scores WHERE facility_type IS NOT NULL
UNION SELECT DISTINCT 'zip', zip FROM risk_scores WHERE zip IS NOT NULL ORDER BY facet, value""")
def facets(spark, sf):
    return D.facets(_scores(spark, sf))


@register("score_range", f"SELECT {SCORE_COLS} FROM risk_scores WHERE dynamic_risk_score BETWEEN {RANGE_LO} AND {RANGE_HI}")
def score_range(spark, sf):
    return D.score_range(_scores(spark, sf), RANGE_LO, RANGE_HI)


@register("multi_select", f"SELECT {SCORE_COLS} FROM risk_scores WHERE facility_type IN "
                          f"({', '.join(O.q(t) for t in SELECT_TYPES)}) AND zip IN ({', '.join(O.q(z) for z in SELECT_ZIPS)})")
def multi_select(spark, sf):
    return D.multi_select(_scores(spark, sf), SELECT_TYPES, SELECT_ZIPS)


@register("kpis", f"""SELECT count(*) AS establishments,
  count(*) FILTER (WHERE dynamic_risk_score >= {O.HIGH}) AS high_risk,
  {O.exact_mean('dynamic_risk_score', 1)} AS avg_risk_score,
  CAST(sum(total_failures) AS BIGINT) AS total_failures, CAST(sum(total_inspections) AS BIGINT) AS total_inspections
FROM risk_scores WHERE dynamic_risk_score BETWEEN 0 AND 100""")
def kpis(spark, sf):
    return D.kpis(D.apply_filters(_scores(spark, sf)))


@register("map_points", """SELECT establishment_id, latitude, longitude, dynamic_risk_score,
  greatest(CAST(10.0 AS DOUBLE), least(CAST(70.0 AS DOUBLE), dynamic_risk_score / CAST(100.0 AS DOUBLE) * CAST(60.0 AS DOUBLE) + CAST(10.0 AS DOUBLE))) AS size
FROM risk_scores WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND dynamic_risk_score BETWEEN 0 AND 100""")
def map_points(spark, sf):
    return D.map_points(D.apply_filters(_scores(spark, sf)))


@register("top_n", f"""SELECT {', '.join(f'{c} AS "{a}"' for c, a in D.TOP_N_COLUMNS.items())}
FROM risk_scores WHERE dynamic_risk_score BETWEEN 0 AND 100
ORDER BY dynamic_risk_score DESC NULLS LAST, establishment_id LIMIT {TOP_N}""")
def top_n(spark, sf):
    return D.top_n(D.apply_filters(_scores(spark, sf)), TOP_N)


_HISTOGRAM_STEP = "CASE " + " ".join(
    f"WHEN greatest(ceil(hi / {w:.1f}) - 1, floor(lo / {w:.1f})) - floor(lo / {w:.1f}) + 1 <= 25 THEN {w:.1f}::DOUBLE"
    for w in (0.1, 0.2, 0.5, 1, 2, 5, 10, 20, 50, 100, 200, 500, 1000)) + " END"


@register("score_histogram", f"""SELECT CAST(least(floor(s / step), greatest(ceil(hi / step) - 1, floor(lo / step))) * step AS DOUBLE)
    AS bin_start, bin_start + max(step) AS bin_end, count(*) AS establishments
FROM (SELECT *, {_HISTOGRAM_STEP} AS step FROM (
  SELECT dynamic_risk_score AS s, min(s) OVER () AS lo, max(s) OVER () AS hi
  FROM risk_scores WHERE dynamic_risk_score BETWEEN 0 AND 100)) GROUP BY 1""")
def score_histogram(spark, sf):
    return D.score_histogram(D.apply_filters(_scores(spark, sf)))


@register("risk_by_facility", f"""SELECT facility_type, {O.exact_mean('dynamic_risk_score', 1)} AS avg_risk,
  count(dynamic_risk_score) AS n FROM risk_scores
WHERE facility_type IS NOT NULL AND dynamic_risk_score BETWEEN 0 AND 100
GROUP BY facility_type HAVING count(dynamic_risk_score) >= 10 ORDER BY avg_risk DESC, facility_type LIMIT 15""")
def risk_by_facility(spark, sf):
    return D.risk_by_facility(D.apply_filters(_scores(spark, sf)))


@register("search", f"SELECT {SCORE_COLS} FROM risk_scores WHERE {_SEARCH_WHERE}")
def search(spark, sf):
    return D.search(_scores(spark, sf), SEARCH_TERM)


@register("search_top20", f"SELECT {SCORE_COLS} FROM ({_MATCHES})")
def search_top20(spark, sf):
    return _matches(spark, sf)


@register("risk_band", f"""SELECT establishment_id, dynamic_risk_score,
  CASE WHEN dynamic_risk_score >= {O.HIGH} THEN 'high' WHEN dynamic_risk_score >= {O.MEDIUM} THEN 'medium' ELSE 'low' END AS band
FROM risk_scores""")
def risk_band(spark, sf):
    return _scores(spark, sf).select("establishment_id", "dynamic_risk_score",
                                     D.risk_band(F.col("dynamic_risk_score")).alias("band"))


_TREND_LABEL = (f"CASE WHEN coalesce(trend_score, 50.0) > {O.WORSE} THEN 'Worsening' "
                f"WHEN coalesce(trend_score, 50.0) < {O.BETTER} THEN 'Improving' ELSE 'Stable' END")


@register("trend_label", f"SELECT establishment_id, trend_score, {_TREND_LABEL} AS trend FROM risk_scores")
def trend_label(spark, sf):
    return _scores(spark, sf).select("establishment_id", "trend_score", D.trend_label(F.col("trend_score")).alias("trend"))


def _whole_sql(c: str) -> str:
    return f"CAST(CAST(round_even({c}, 0) AS BIGINT) AS VARCHAR) || '/100'"


@register("detail_card", f"""SELECT establishment_id, {_whole_sql('failure_rate_score')} AS failure_rate,
  {_whole_sql('recency_score')} AS recency, {_whole_sql('violation_severity_score')} AS violation_severity,
  {_TREND_LABEL} AS trend, facility_type AS type, risk_category AS city_risk_category,
  total_inspections AS inspections, coalesce(strftime(last_inspection_date, '%Y-%m-%d'), 'N/A') AS last_inspected
FROM ({_MATCHES})""")
def detail_card(spark, sf):
    return D.detail_card(_matches(spark, sf))


@register("card_label", f"""SELECT establishment_id,
  CASE WHEN dynamic_risk_score >= {O.HIGH} THEN 'high' WHEN dynamic_risk_score >= {O.MEDIUM} THEN 'medium' ELSE 'low' END AS band,
  coalesce(dba_name, 'N/A') || ' — ' || coalesce(address, 'N/A') || ' — Score: ' || coalesce(CAST(dynamic_risk_score AS VARCHAR), 'N/A') AS label
FROM ({_MATCHES})""")
def card_label(spark, sf):
    return D.card_label(_matches(spark, sf))


@register("inspection_history", f"""SELECT establishment_id, CAST(rank AS INTEGER) AS rank,
  {', '.join(f'{c} AS "{a}"' for c, a in D.HISTORY_COLUMNS.items())}
FROM (SELECT i.*, row_number() OVER (PARTITION BY establishment_id ORDER BY inspection_date DESC, inspection_id DESC) AS rank
      FROM inspections i WHERE establishment_id IN (SELECT establishment_id FROM ({_MATCHES})))
WHERE rank <= 10""")
def inspection_history(spark, sf):
    insp = _insp_once(spark, sf)
    matches = D.search_top(R.risk_scores(insp, AS_OF), SEARCH_TERM, TOP_N)
    return D.inspection_history(matches, insp, 10)


@register("bucketed_history", f"""SELECT establishment_id, CAST(rank AS INTEGER) AS rank,
  {', '.join(f'{c} AS "{a}"' for c, a in D.HISTORY_COLUMNS.items())}
FROM (SELECT i.*, row_number() OVER (PARTITION BY establishment_id ORDER BY inspection_date DESC, inspection_id DESC) AS rank
      FROM inspections i WHERE establishment_id IN (SELECT establishment_id FROM ({_MATCHES})))
WHERE rank <= 10""")
def bucketed_history(spark, sf):
    """K8 + D15: history served from the establishment-bucketed inspections table, with
    at least as many buckets as the session has shuffle partitions."""
    import uuid
    insp = _insp(spark, sf)
    name = f"hazardlens_inspections_{uuid.uuid4().hex[:8]}"
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    K.bucketed_inspections(insp.drop("kw_found", "violation_codes"), name, buckets, staging_path(spark, "bucketed"))
    stored = spark.table(name)
    matches = D.search_top(R.risk_scores(stored, AS_OF), SEARCH_TERM, TOP_N)
    return D.inspection_history(matches, stored, 10)


@register("risk_by_zip", _RISK_BY_ZIP.replace("WHERE zip IS NOT NULL", "WHERE zip IS NOT NULL AND dynamic_risk_score BETWEEN 0 AND 100"))
def risk_by_zip(spark, sf):
    return D.risk_by_zip(D.apply_filters(_scores(spark, sf)))


@register("zip_table", f"""SELECT zip AS "ZIP", {O.round1('avg_risk')} AS "Avg Risk", n_establishments AS "Establishments",
  high_risk AS "High Risk (>=70)" FROM ({_RISK_BY_ZIP}) ORDER BY avg_risk DESC, zip LIMIT 15""")
def zip_table(spark, sf):
    return D.zip_table(_scores(spark, sf))


@register("zip_chart", f"SELECT * FROM ({_RISK_BY_ZIP}) ORDER BY avg_risk DESC, zip LIMIT 20")
def zip_chart(spark, sf):
    return D.zip_chart(_scores(spark, sf))


@register("cached_scores", f"SELECT {SCORE_COLS} FROM risk_scores")
def cached_scores(spark, sf):
    """D19 over a stored table: cached by its own path, so no other query's plan meets the cache."""
    path = staging_path(spark, "scores-cached")
    K.write_parquet(_scores(spark, sf), path)
    return D.load_cached(spark, path)


# ---------------------------------------------------------------- panels from one stored rollup

def _stored_rollup(spark, sf) -> DataFrame:
    path = staging_path(spark, "score-rollup")
    RU.score_rollup(_scores(spark, sf)).write.parquet(path)
    return spark.read.parquet(path)


def _panel(name: str, like: str, panel: Callable[[DataFrame], DataFrame]):
    """A panel from the stored rollup, held against the SQL of the panel over the scores."""
    def query(spark, sf):
        return panel(RU.panel_sums(D.apply_filters(_stored_rollup(spark, sf))))
    _QUERIES[name], _SQL[name] = query, _SQL[like]


_panel("rollup_kpis", "kpis", RU.kpis)
_panel("rollup_histogram", "score_histogram", RU.score_histogram)
_panel("rollup_by_facility", "risk_by_facility", RU.risk_by_facility)
_panel("rollup_by_zip", "risk_by_zip", RU.risk_by_zip)
_panel("rollup_zip_table", "zip_table", RU.zip_table)
_panel("rollup_zip_chart", "zip_chart", RU.zip_chart)


# ---------------------------------------------------------------- access paths

def _stored_with_postings(spark, sf) -> tuple[DataFrame, DataFrame]:
    table, index = staging_path(spark, "scores-searched"), staging_path(spark, "postings")
    K.write_parquet(_scores(spark, sf), table)
    scores = spark.read.parquet(table)
    SI.store_postings(scores, index)
    return scores, spark.read.parquet(index)


@register("search_postings", f"SELECT {SCORE_COLS} FROM risk_scores WHERE {_SEARCH_WHERE}")
def search_postings(spark, sf):
    """D9 through stored postings of three-letter sequences."""
    return SI.search(*_stored_with_postings(spark, sf), SEARCH_TERM)


@register("search_postings_top20", f"SELECT {SCORE_COLS} FROM ({_MATCHES})")
def search_postings_top20(spark, sf):
    return SI.search_top(*_stored_with_postings(spark, sf), SEARCH_TERM, TOP_N)


@register("zordered_select", f"""SELECT {SCORE_COLS} FROM risk_scores WHERE zip IN ({', '.join(O.q(z) for z in SELECT_ZIPS)})
  AND dynamic_risk_score BETWEEN {RANGE_LO} AND {RANGE_HI}""")
def zordered_select(spark, sf):
    """K8 + D2 + D3: ZIPs and a score range from the scores along a curve over both."""
    path = staging_path(spark, "scores-zordered")
    LY.zordered(_scores(spark, sf), path)
    return D.apply_filters(spark.read.parquet(path), RANGE_LO, RANGE_HI, zips=SELECT_ZIPS)


PERIOD = ("1998-01-01", "1998-03-31")


@register("dated_period", f"""SELECT {INSP_COLS} FROM inspections
WHERE inspection_date BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'""")
def dated_period(spark, sf):
    """K8: a period's inspections from the table in ranges of the date."""
    path = staging_path(spark, "inspections-dated")
    LY.dated(_insp(spark, sf).select(INSPECTION_COLUMNS), path)
    return LY.period(spark.read.parquet(path), *PERIOD)


# ---------------------------------------------------------------- X: exploration

_CANDIDATES = "SELECT * FROM inspections WHERE results = 'fail' AND length(violations) > 50"
_SAMPLE = f"SELECT * FROM ({_CANDIDATES}) ORDER BY md5(inspection_id || '42'), inspection_id LIMIT 5"
_REPORT = f"""SELECT inspection_id, dba_name, strftime(inspection_date, '%Y-%m-%d') AS inspection_day, results, risk,
  facility_type, substring(violations, 1, 500) AS violations_preview,
  array_to_string(violation_codes, ',') AS violation_codes, n_critical, n_serious, n_minor,
  array_to_string(kw_found, ',') AS kw_found, kw_critical, kw_major, kw_minor, violation_severity
FROM ({_SAMPLE})"""


@register("explore_candidates", f"SELECT inspection_id, establishment_id, results, length(violations) AS text_length "
                                f"FROM ({_CANDIDATES})")
def explore_candidates(spark, sf):
    return X.explore_candidates(_insp(spark, sf)).select(
        "inspection_id", "establishment_id", "results", F.length("violations").alias("text_length"))


@register("explore_sample", f"SELECT inspection_id, establishment_id, results FROM ({_SAMPLE})")
def explore_sample(spark, sf):
    return X.explore_sample(_insp(spark, sf)).select("inspection_id", "establishment_id", "results")


@register("explore_report", _REPORT)
def explore_report(spark, sf):
    return X.explore_report(X.explore_sample(_insp(spark, sf)))


@register("explore_mode", _REPORT)
def explore_mode(spark, sf):
    return run_transform(spark, _raw(spark, sf), AS_OF, mode="explore").report


# ---------------------------------------------------------------- streaming refresh

def _halves(df):
    """``df`` as two ranges of the landing order, cut where Spark's range exchange would."""
    order = F.struct(*L.DEFAULT_ORDER)
    keys = df.select(*L.DEFAULT_ORDER).repartitionByRange(2, *(F.col(c).asc_nulls_first() for c in L.DEFAULT_ORDER))
    first = sorted(keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(order).alias("first")).collect())
    if len(first) < 2:
        return [df]
    cut = F.struct(*(F.lit(first[1]["first"][c]).cast(RAW[c].dataType).alias(c) for c in L.DEFAULT_ORDER))
    return [df.filter(order < cut), df.filter(order >= cut)]


def _land_drops(spark, sf, landing):
    """Lands the two drops, each when the next one is asked for, in halves so that
    fewer rows are shuffled at once. What is stored of the raw records goes as soon
    as it has landed."""
    path = staging_path(spark, "raw")
    with shuffles_dropped(spark):
        _raw(spark, sf).write.options(**COMPACT).parquet(path)
    for drop, seq in (("drop1", 0), ("drop2", 1)):
        raw, rest = spark.read.schema(RAW).parquet(path), staging_path(spark, "raw")
        with shuffles_dropped(spark):
            for n, half in enumerate(_halves(raw.filter(F.col("ingest_seq") == seq))):
                L.land_pages(half, f"{landing}/{drop}/{n}", PAGE_SIZE_TEST, RAW_TEXT_COLUMNS, compression="gzip")
            raw.filter(F.col("ingest_seq") > seq).write.options(**COMPACT).parquet(rest)
        drop_staged(spark, path)
        path = rest
        yield drop
    drop_staged(spark, path)


@register("streaming_refresh", f"SELECT {SCORE_COLS} FROM risk_scores")
def streaming_refresh(spark, sf):
    """Pages land in two drops; the file stream refreshes the tables after each."""
    landing = staging_path(spark, "landing")
    raw_dir, out_dir, ckpt = (staging_path(spark, n) for n in ("stream-raw", "stream-out", "stream-ckpt"))
    for _ in _land_drops(spark, sf, landing):
        start_refresh(spark, landing, raw_dir, out_dir, ckpt, AS_OF).awaitTermination()
    return latest_output(spark, out_dir)[1].select(SCORES.fieldNames())


@register("incremental_refresh", f"SELECT {SCORE_COLS} FROM risk_scores")
def incremental_refresh(spark, sf):
    """The same drops into bucketed tables: each batch rewrites the buckets it
    touches, and scores come from the establishments' states."""
    landing = staging_path(spark, "landing")
    raw_dir, out_dir, ckpt = (staging_path(spark, n) for n in ("inc-raw", "inc-out", "inc-ckpt"))
    for _ in _land_drops(spark, sf, landing):
        start_refresh(spark, landing, raw_dir, out_dir, ckpt, AS_OF, buckets=8).awaitTermination()
    return latest_output(spark, out_dir)[1].select(SCORES.fieldNames())
