"""Hand goldens for cleaning and scoring, plus metamorphic properties."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, raw_rows, record
from hazardlens.functions.numeric import floor_days, round1
from hazardlens.operators.clean import clean
from hazardlens.operators.scoring import as_of_literal, risk_scores
from hazardlens.operators.signals import parse_violations

AS_OF_DAY = "2001-09-01"


def score(spark, rows, as_of=AS_OF_DAY + " 00:00:00"):
    df = parse_violations(clean(raw_rows(spark, rows)))
    return {r.establishment_id: r for r in risk_scores(df, as_of).collect()}


def test_failure_rate_weighted_by_type(spark):
    rows = [record(inspection_id="1", inspection_type="Complaint", results="Fail", inspection_date="2001-01-01"),
            record(inspection_id="2", inspection_type="Canvass", results="Pass w/ Conditions", inspection_date="2001-01-02"),
            record(inspection_id="3", inspection_type="License", results="Pass", inspection_date="2001-01-03")]
    r = score(spark, rows)["L1"]
    assert r.failure_rate_score == 60.6
    assert (r.total_inspections, r.total_failures, r.total_conditional, r.total_passes) == (3, 1, 1, 1)
    assert r.trend_score == 50.0          # n = 3 is inside the trend window -> always 50


def test_recency_curve(spark):
    # last failure 180 days before as_of -> half-life
    r = score(spark, [record(results="Fail", inspection_date="2001-03-05")])["L1"]
    assert r.recency_score == 50.0
    # conditional counts as a failure for recency
    r = score(spark, [record(results="Pass w/ Conditions", inspection_date=AS_OF_DAY)])["L1"]
    assert r.recency_score == 100.0
    # passes only
    r = score(spark, [record(results="Pass")])["L1"]
    assert r.recency_score == 0.0
    # future failure: not clamped
    r = score(spark, [record(results="Fail", inspection_date="2001-09-02")])["L1"]
    assert r.recency_score == 100.4


def test_days_floor_negative(spark):
    df = spark.range(1).select(floor_days(F.lit("2001-09-02 00:00:00").cast("timestamp_ntz"),
                                          as_of_literal("2001-09-01 12:00:00")).alias("d"))
    assert df.collect()[0].d == -1


def test_trend(spark):
    outcomes = ["Fail", "Fail", "Pass", "Pass", "Pass", "Pass", "Pass"]   # oldest first
    rows = [record(inspection_id=str(i), results=o, inspection_date=f"2001-01-{i + 10:02d}")
            for i, o in enumerate(outcomes)]
    assert score(spark, rows)["L1"].trend_score == 35.7
    assert score(spark, rows[:2])["L1"].trend_score == 50.0


def test_same_day_tie_broken_by_id(spark):
    rows = [record(inspection_id="10", results="Fail", dba_name="Old", inspection_date="2001-05-05"),
            record(inspection_id="11", results="Pass", dba_name="New", inspection_date="2001-05-05")]
    r = score(spark, rows)["L1"]
    assert r.dba_name == "New" and r.last_result == "pass"


def test_composite(spark):
    text = "32. FOO - Comments: mice near wall | 33. BAR"
    rows = [record(results="Fail", inspection_type="Complaint", inspection_date="2001-03-05", violations=text)]
    r = score(spark, rows)["L1"]
    assert r.violation_severity_score == 25.9
    assert r.dynamic_risk_score == 55.3


def test_round_half_even(spark):
    assert spark.range(1).select(round1(F.lit(6.25)).alias("x")).collect()[0].x == 6.2


def test_dedup_unusable_dropped_first(spark):
    rows = [record(results="Fail", ingest_seq=0), record(results="Out of Business", ingest_seq=1)]
    out = clean(raw_rows(spark, rows)).collect()
    assert [r.results for r in out] == ["fail"]
    rows = [record(results="Pass", ingest_seq=0), record(results="Fail", ingest_seq=1)]
    out = clean(raw_rows(spark, rows)).collect()
    assert [r.results for r in out] == ["fail"]


@pytest.mark.parametrize("lic", [None, "   ", ""])
def test_establishment_key_fallback(spark, lic):
    out = clean(raw_rows(spark, [record(license_=lic, dba_name=" Joe's ", address="1 N ST")])).collect()
    assert out[0].establishment_id == "joe's|1 n st"


def test_unusable_rows_dropped(spark):
    rows = [record(inspection_id="1", results=None), record(inspection_id="2", results="unknown"),
            record(inspection_id="3", results="No Entry"), record(inspection_id="4", inspection_date="n/a"),
            record(inspection_id="5", inspection_date="2024"), record(inspection_id="6", results=" PASS ")]
    out = clean(raw_rows(spark, rows)).collect()
    assert [r.inspection_id for r in out] == ["6"]


def test_empty_input_keeps_schema(spark):
    df = parse_violations(clean(raw_rows(spark, [])))
    out = risk_scores(df, AS_OF)
    assert out.count() == 0 and len(out.columns) == 20


def test_metamorphic_partitioning_and_order(spark):
    from hazardlens.sources.fixtures import raw_inspections
    raw = raw_inspections(spark, "/root/testdata/sf0.001")
    base = sorted(map(tuple, risk_scores(parse_violations(clean(raw)), AS_OF).collect()))
    shuffled = raw.repartition(3, F.rand(7)).orderBy(F.rand(11))
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = sorted(map(tuple, risk_scores(parse_violations(clean(shuffled)), AS_OF).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert base == again
    for r in base:
        d = dict(zip(risk_scores(parse_violations(clean(raw)), AS_OF).columns, r))
        assert d["total_inspections"] == d["total_failures"] + d["total_conditional"] + d["total_passes"]
        assert 0.0 <= d["dynamic_risk_score"] <= 100.0
        if 3 <= d["total_inspections"] <= 5:
            assert d["trend_score"] == 50.0


def test_recency_shift_by_half_life(spark):
    rows = [record(results="Fail", inspection_date="2001-01-01")]
    df = parse_violations(clean(raw_rows(spark, rows)))
    from hazardlens.operators.scoring import components
    a = components(df, "2001-06-01 00:00:00").collect()[0].recency
    b = components(df, "2001-11-28 00:00:00").collect()[0].recency
    assert b == pytest.approx(a * math.exp(-0.693), rel=1e-12)


def test_minimal_raw_columns(spark):
    """Only the required columns: optional text becomes null, no id means no dedup."""
    rows = [("  A ", "1 N ST", "L1", "2001-08-01T00:00:00.000", "Canvass", "Fail", "3. x"),
            ("  A ", "1 N ST", "L1", "2001-08-01T00:00:00.000", "Canvass", "Fail", "3. x"),
            ("B", "2 N ST", None, "2001-07-01", "Complaint", "Pass", None)]
    raw = spark.createDataFrame(rows, "dba_name string, address string, license_ string, inspection_date string, "
                                      "inspection_type string, results string, violations string")
    out = parse_violations(clean(raw))
    assert out.count() == 3                       # identical rows are kept: there is no id to dedup on
    r = out.filter("establishment_id = 'L1'").first()
    assert r.aka_name is None and r.zip is None and r.latitude is None and r.n_critical == 1
    scores = {x.establishment_id: x for x in risk_scores(out, AS_OF).collect()}
    assert scores["L1"].total_inspections == 2 and scores["b|2 n st"].total_passes == 1


def test_date_formats(spark):
    rows = [record(inspection_id=str(i), inspection_date=d) for i, d in enumerate(
        ["2010-01-04T00:00:00.000", "2010-01-04", " 2010-01-04 10:30:00 ", "01/04/2010", "2010", "12:30", None])]
    got = {r.inspection_id: r.inspection_date for r in clean(raw_rows(spark, rows)).collect()}
    assert sorted(got) == ["0", "1", "2"]
    assert str(got["2"]) == "2010-01-04 10:30:00"


def test_clean_report_without_ids(spark):
    from hazardlens.operators.clean import clean_report
    raw = spark.createDataFrame([("A", "1 N ST", "L", "2001-01-01", "x", "Pass", "")] * 3,
                                "dba_name string, address string, license_ string, inspection_date string, "
                                "inspection_type string, results string, violations string")
    rep = {r.metric: r.n for r in clean_report(raw).collect()}
    assert rep["remaining"] == 3 and rep["duplicates"] == 0


def test_missing_required_column_fails(spark):
    raw = spark.createDataFrame([("A", "2001-01-01")], "dba_name string, inspection_date string")
    with pytest.raises(ValueError, match="results"):
        clean(raw)


def test_config_flows_through(spark):
    from dataclasses import replace
    from decimal import Decimal
    from hazardlens.config import DEFAULT_CONFIG
    outcomes = ["Fail", "Fail", "Pass", "Pass", "Pass", "Pass", "Pass"]
    rows = [record(inspection_id=str(i), results=o, inspection_type="Complaint",
                   inspection_date=f"2001-01-{i + 10:02d}") for i, o in enumerate(outcomes)]
    df = parse_violations(clean(raw_rows(spark, rows)))
    base = risk_scores(df, AS_OF).first()
    cfg = replace(DEFAULT_CONFIG, trend_window=7,
                  type_weights={**DEFAULT_CONFIG.type_weights, "complaint": Decimal("1.0")})
    alt = risk_scores(df, AS_OF, cfg).first()
    assert base.trend_score == 35.7 and alt.trend_score == 50.0      # window covers all 7 -> no trend
    assert base.failure_rate_score == alt.failure_rate_score == 28.6  # one weight everywhere: rate unchanged
