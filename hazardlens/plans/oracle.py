"""Independent DuckDB SQL for every registered query (the correctness oracle).

Built as one chain of CTEs — raw fixture -> cleaned -> signals -> scores —
that each query's SQL ends with its own SELECT. DuckDB only evaluates the
CTEs a query references.
"""

from __future__ import annotations

from ..config import (DEFAULT_CONFIG, HIGH_RISK, MEDIUM_RISK, TREND_IMPROVING,
                      TREND_WORSENING)
from ..functions.text import WHITESPACE
from ..sources.fixtures import COMMENT_BY_SUPPKEY_MOD10, TYPE_BY_ORDERKEY_MOD9

CFG = DEFAULT_CONFIG
CODE_RE = r"(?:^|\|)\s*([0-9]{1,2})\.\s"


def q(s: str | None) -> str:
    """SQL string literal (or NULL)."""
    return "NULL" if s is None else "'" + s.replace("'", "''") + "'"


def _ws_chars() -> str:
    """The same whitespace set the Spark ``strip`` trims, as a SQL string expression."""
    return "(" + " || ".join(f"chr({ord(c)})" for c in WHITESPACE) + ")"


_WS = _ws_chars()


def strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def d(x: float) -> str:
    """A DOUBLE literal (a bare ``0.25`` would be DECIMAL in DuckDB)."""
    return f"CAST({x!r} AS DOUBLE)"


def round1(x: str) -> str:
    """Half-even rounding to one decimal, like Spark's ``rint(x*10)/10``."""
    return f"(round_even(({x}) * 10.0, 0) / 10.0)"


def scaled(x: str, s: int) -> str:
    """A value with at most ``s`` decimals as an integer count of 10^-s units."""
    return f"CAST(round(({x}) * {10 ** s}.0) AS BIGINT)"


def exact_sum(x: str, s: int) -> str:
    return f"(CAST(SUM({scaled(x, s)}) AS DOUBLE) / {10 ** s}.0)"


def exact_mean(x: str, s: int) -> str:
    return f"({exact_sum(x, s)} / COUNT({x}))"


def median(x: str) -> str:
    """Median as (lower middle + upper middle) / 2 — the interpolation Spark uses."""
    return f"((quantile_disc({x}, 0.5) + -quantile_disc(-({x}), 0.5)) * 0.5)"


def _comment_case() -> str:
    whens = " ".join(f"WHEN {i} THEN {q(t)}" for i, t in enumerate(COMMENT_BY_SUPPKEY_MOD10))
    return f"CASE l_suppkey % 10 {whens} END"


def _type_case() -> str:
    whens = " ".join(f"WHEN {i} THEN {q(t)}" for i, t in enumerate(TYPE_BY_ORDERKEY_MOD9) if t is not None)
    return f"CASE o_orderkey % 9 {whens} ELSE NULL END"


RAW_CTES = f"""
ord AS (
  SELECT o.*, CAST(0 AS BIGINT) AS ingest_seq FROM orders o
  UNION ALL
  SELECT o.*, CAST(1 AS BIGINT) AS ingest_seq FROM orders o WHERE o_orderkey % 50 = 0
), frag AS (
  SELECT l_orderkey,
    concat(CAST((l_partkey + l_linenumber) % 75 AS VARCHAR), '. ', upper(p_type), ' - Comments: ',
      {_comment_case()}, p_name) AS f
  FROM lineitem JOIN part ON l_partkey = p_partkey
), viol AS (
  SELECT l_orderkey, string_agg(f, ' | ' ORDER BY f) AS violations FROM frag GROUP BY l_orderkey
), raw_inspections AS (
SELECT CAST(o_orderkey AS VARCHAR) AS inspection_id,
  concat('  ', c_name, ' ') AS dba_name,
  CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE n_name END AS aka_name,
  CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 13 = 0 THEN '   ' ELSE CAST(o_custkey AS VARCHAR) END AS license_,
  c_mktsegment AS facility_type,
  CASE o_custkey % 3 WHEN 0 THEN 'Risk 1 (High)' WHEN 1 THEN 'Risk 2 (Medium)' ELSE 'Risk 3 (Low)' END AS risk,
  concat(CAST(o_custkey AS VARCHAR), ' N ', n_name, ' ST') AS address,
  CASE WHEN c_nationkey = 24 THEN NULL ELSE CAST(60600 + c_nationkey AS VARCHAR) END AS zip,
  CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_orderdate AS VARCHAR) END AS inspection_date,
  {_type_case()} AS inspection_type,
  CASE WHEN ingest_seq = 1 THEN 'Fail' WHEN o_orderkey % 13 = 0 THEN 'Out of Business' WHEN o_orderkey % 17 = 0 THEN 'No Entry'
    WHEN o_orderkey % 101 = 0 THEN NULL
    WHEN o_orderstatus = 'F' THEN 'Fail' WHEN o_orderstatus = 'O' THEN ' Pass' ELSE 'Pass w/ Conditions' END AS results,
  violations,
  CASE WHEN o_custkey % 19 = 0 THEN NULL WHEN o_custkey % 23 = 0 THEN 'bad'
    ELSE concat('41.', lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0')) END AS latitude,
  CASE WHEN o_custkey % 19 = 0 THEN NULL ELSE concat('-87.', lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0')) END AS longitude,
  ingest_seq
FROM ord JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN viol ON l_orderkey = o_orderkey
)"""

_usable = ", ".join(q(k) for k in CFG.usable_results)
_score_case = " ".join(f"WHEN {q(k)} THEN {d(v)}" for k, v in CFG.result_scores.items() if v is not None)
_RAW_ORDER = ["dba_name", "aka_name", "license_", "facility_type", "risk", "address", "zip",
              "inspection_date", "inspection_type", "results", "violations", "latitude", "longitude",
              "result_score"]
_tiebreak = ", ".join(f"{c} DESC NULLS LAST" for c in _RAW_ORDER)


def parsed_date(x: str) -> str:
    s = strip(x)
    return f"CASE WHEN regexp_matches({s}, '^\\s*[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({s} AS TIMESTAMP) END"


CLEAN_CTES = f"""
c_dates AS (
  SELECT * REPLACE ({parsed_date('inspection_date')} AS inspection_date) FROM raw_inspections
), c_valid AS (
  SELECT * FROM c_dates WHERE inspection_date IS NOT NULL
), c_results AS (
  SELECT * REPLACE (lower({strip('results')}) AS results) FROM c_valid
), c_usable AS (
  SELECT *, CASE results {_score_case} END AS result_score FROM c_results WHERE results IN ({_usable})
), c_dedup AS (
  SELECT * FROM c_usable
  QUALIFY row_number() OVER (PARTITION BY inspection_id ORDER BY ingest_seq DESC NULLS LAST, {_tiebreak}) = 1
), c_text AS (
  SELECT * REPLACE (
    lower({strip('inspection_type')}) AS inspection_type,
    {strip('dba_name')} AS dba_name, {strip('aka_name')} AS aka_name, {strip('address')} AS address,
    {strip('facility_type')} AS facility_type, {strip('risk')} AS risk, {strip('zip')} AS zip,
    coalesce(violations, '') AS violations,
    TRY_CAST({strip('latitude')} AS DOUBLE) AS latitude,
    TRY_CAST({strip('longitude')} AS DOUBLE) AS longitude,
    {strip('license_')} AS license_)
  FROM c_dedup
), cleaned AS (
  SELECT *, CASE WHEN length(license_) > 0 THEN license_
    ELSE concat(lower(coalesce(dba_name, '')), '|', lower(coalesce(address, ''))) END AS establishment_id
  FROM c_text
)"""


def _kw_list(tier: str) -> str:
    return "[" + ", ".join(q(k) for k in CFG.keyword_tiers[tier]) + "]"


def keyword_filter(tier: str, lowered: str) -> str:
    return f"list_filter({_kw_list(tier)}::VARCHAR[], lambda k: contains({lowered}, k))"


def codes_expr(text: str) -> str:
    return (f"list_filter(list_transform(regexp_extract_all(coalesce({text}, ''), '{CODE_RE}', 1), "
            f"lambda s: CAST(s AS INTEGER)), lambda n: (n BETWEEN 1 AND 44) OR n = 70)")


def severity_expr(nc, ns, nm, kc, km, kn) -> str:
    w, k = CFG.code_weights, CFG.keyword_weights
    st = f"({nc} * {d(w['critical'])} + {ns} * {d(w['serious'])} + {nm} * {d(w['minor'])})"
    kw = f"({kc} * {d(k['critical'])} + {km} * {d(k['major'])} + {kn} * {d(k['minor'])})"
    raw = f"(({st} + {kw}) / {d(2.0)})"
    curve = f"({d(100.0)} * ({d(1.0)} - exp(-{raw} / {d(CFG.severity_scale)})))"
    return f"round(least({curve}, {d(100.0)}), 2)"


SIGNAL_CTES = f"""
s_base AS (
  SELECT *, {codes_expr('violations')} AS violation_codes,
    {keyword_filter('critical', 'lower(violations)')} AS _kc,
    {keyword_filter('major', 'lower(violations)')} AS _km,
    {keyword_filter('minor', 'lower(violations)')} AS _kn
  FROM cleaned
), s_counts AS (
  SELECT * EXCLUDE (_kc, _km, _kn),
    CAST(len(list_filter(violation_codes, lambda n: n BETWEEN 1 AND 14)) AS INTEGER) AS n_critical,
    CAST(len(list_filter(violation_codes, lambda n: n BETWEEN 15 AND 29)) AS INTEGER) AS n_serious,
    CAST(len(list_filter(violation_codes, lambda n: (n BETWEEN 30 AND 44) OR n = 70)) AS INTEGER) AS n_minor,
    CAST(len(_kc) AS INTEGER) AS kw_critical, CAST(len(_km) AS INTEGER) AS kw_major,
    CAST(len(_kn) AS INTEGER) AS kw_minor,
    list_concat(list_concat(_kc, _km), _kn) AS kw_found
  FROM s_base
), inspections AS (
  SELECT *, {severity_expr('n_critical', 'n_serious', 'n_minor', 'kw_critical', 'kw_major', 'kw_minor')} AS violation_severity
  FROM s_counts
)"""

AS_OF = "2001-09-01 12:00:00"
_type_weight_case = " ".join(f"WHEN {q(k)} THEN CAST('{v}' AS DECIMAL(2,1))" for k, v in CFG.type_weights.items())
_rw = CFG.risk_weights


def score_ctes(as_of: str = AS_OF) -> str:
    days = f"floor((epoch_us(TIMESTAMP '{as_of}') - epoch_us(last_failure_date)) / 86400000000)"
    recency = (f"CASE WHEN last_failure_date IS NULL THEN {d(0.0)} ELSE {d(100.0)} * "
               f"exp({d(-CFG.recency_decay)} * CAST(days_since_failure AS DOUBLE) / {d(CFG.half_life_days)}) END")
    failure = (f"(CASE WHEN total_weight > 0 THEN weighted_failures / total_weight ELSE {d(0.0)} END) * {d(100.0)}")
    trend = (f"CASE WHEN n >= {CFG.trend_min_inspections} THEN greatest({d(0.0)}, least({d(100.0)}, "
             f"{d(50.0)} + (recent_avg - overall_avg) * {d(50.0)})) ELSE {d(50.0)} END")
    composite = (f"{d(_rw['failure_rate'])} * failure_rate + {d(_rw['recency'])} * recency + "
                 f"{d(_rw['violation_severity'])} * severity + {d(_rw['trend'])} * trend")
    latest = ", ".join(f"max({c}) FILTER (WHERE recency_rank = 1) AS latest_{c}" for c in
                       ["dba_name", "aka_name", "address", "zip", "facility_type", "risk",
                        "latitude", "longitude", "inspection_date", "results"])
    return f"""
sc_in AS (
  SELECT *, coalesce(CASE inspection_type {_type_weight_case} END, CAST('{CFG.type_weight_default}' AS DECIMAL(2,1))) AS type_weight
  FROM inspections WHERE establishment_id IS NOT NULL
), sc_rank AS (
  SELECT *, row_number() OVER (PARTITION BY establishment_id ORDER BY inspection_date DESC, inspection_id DESC) AS recency_rank
  FROM sc_in
), sc_agg AS (
  SELECT establishment_id,
    count(*) AS n,
    count(*) FILTER (WHERE result_score = 1.0) AS n_fail,
    count(*) FILTER (WHERE result_score = 0.5) AS n_conditional,
    count(*) FILTER (WHERE result_score = 0.0) AS n_pass,
    CAST(SUM({scaled('result_score', 1)} * {scaled('type_weight', 1)}) AS DOUBLE) / 100.0 AS weighted_failures,
    {exact_sum('type_weight', 1)} AS total_weight,
    max(CASE WHEN result_score > 0 THEN inspection_date END) AS last_failure_date,
    {exact_mean('violation_severity', 2)} AS severity_mean,
    {exact_mean('result_score', 1)} AS overall_avg,
    CAST(SUM({scaled('result_score', 1)}) FILTER (WHERE recency_rank <= {CFG.trend_window}) AS DOUBLE) / 10.0
      / COUNT(result_score) FILTER (WHERE recency_rank <= {CFG.trend_window}) AS recent_avg,
    {latest}
  FROM sc_rank GROUP BY establishment_id
), sc_days AS (
  SELECT *, CAST({days} AS BIGINT) AS days_since_failure FROM sc_agg
), sc_comp AS (
  SELECT *, {failure} AS failure_rate, {recency} AS recency, severity_mean AS severity, {trend} AS trend
  FROM sc_days
), components AS (
  SELECT *, {composite} AS composite FROM sc_comp
), risk_scores AS (
  SELECT establishment_id, latest_dba_name AS dba_name, latest_aka_name AS aka_name,
    latest_address AS address, latest_zip AS zip, latest_facility_type AS facility_type,
    latest_risk AS risk_category, latest_latitude AS latitude, latest_longitude AS longitude,
    CAST(n AS INTEGER) AS total_inspections, CAST(n_fail AS INTEGER) AS total_failures,
    CAST(n_conditional AS INTEGER) AS total_conditional, CAST(n_pass AS INTEGER) AS total_passes,
    latest_inspection_date AS last_inspection_date, latest_results AS last_result,
    {round1('failure_rate')} AS failure_rate_score,
    {round1('recency')} AS recency_score,
    {round1('severity')} AS violation_severity_score,
    {round1('trend')} AS trend_score,
    {round1(f"greatest({d(0.0)}, least({d(100.0)}, composite))")} AS dynamic_risk_score
  FROM components
)"""


def with_chain(body: str, as_of: str = AS_OF) -> str:
    """Full CTE chain + the query's own SELECT."""
    return f"WITH {RAW_CTES},{CLEAN_CTES},{SIGNAL_CTES},{score_ctes(as_of)}\n{body}"


# SQL fragments the registry reuses.
HIGH = d(HIGH_RISK)
MEDIUM = d(MEDIUM_RISK)
WORSE = d(TREND_WORSENING)
BETTER = d(TREND_IMPROVING)
