"""The command line runs the original workflow end to end on landed pages."""

from conftest import AS_OF, SF_SMALL
from hazardlens.__main__ import main
from hazardlens.schemas import RAW_TEXT_COLUMNS
from hazardlens.session import staging_path
from hazardlens.sources import landed as L
from hazardlens.sources.fixtures import raw_inspections


def test_cli_workflow(spark, capsys):
    pages = L.land_pages(raw_inspections(spark, SF_SMALL), staging_path(spark, "cli-pages"), 500, RAW_TEXT_COLUMNS)
    tables, copy = staging_path(spark, "cli-tables"), staging_path(spark, "cli-copy")
    assert main(["profile", "--raw", pages]) == 0
    assert main(["transform", "--raw", pages, "--out", tables, "--as-of", AS_OF]) == 0
    assert main(["transform", "--raw", pages, "--as-of", AS_OF, "--explore"]) == 0
    assert main(["load", "--tables", tables, "--to", copy]) == 0
    assert main(["load", "--tables", tables, "--to", copy]) == 0            # a refresh: the tables do not double
    assert spark.read.parquet(f"{copy}/risk_scores").count() == spark.read.parquet(f"{tables}/risk_scores").count()
    assert main(["verify", "--tables", copy]) == 0
    snaps = staging_path(spark, "cli-snapshots")
    assert main(["load", "--tables", tables, "--to", snaps, "--snapshots"]) == 0 == main(["verify", "--tables", snaps])
    assert main(["query", "kpis", "--sf-dir", SF_SMALL]) == 0
    out = capsys.readouterr().out
    assert "risk_scores" in out and "violations_preview" in out and "n_licenses" in out and "duplicates:" in out
    assert spark.read.parquet(f"{copy}/risk_scores").schema["dynamic_risk_score"].dataType.typeName() == "float"


def test_observed_counters_match_clean_report(spark):
    from hazardlens.operators.clean import clean_report
    from hazardlens.plans.batch import run_transform
    raw = raw_inspections(spark, SF_SMALL)
    res = run_transform(spark, raw, AS_OF, out_dir=staging_path(spark, "obs"))
    expect = {r.metric: r.n for r in clean_report(raw).collect()}
    assert {k: res.counters[k] for k in expect} == expect
    assert res.counters["n_establishments"] == res.scores.count()
    totals = res.inspections.selectExpr("sum(size(violation_codes))", "sum(kw_critical + kw_major + kw_minor)").first()
    assert (res.counters["total_codes"], res.counters["total_keyword_hits"]) == tuple(totals)
    assert 0 < res.counters["median_severity"] <= res.counters["max_severity"] <= 100


def test_cli_stores_the_raw_pull_and_passes_columns_through(spark, tmp_path):
    import json
    record = {"inspection_id": "1", "dba_name": "A", "address": "1 N", "license_": "L", "inspection_date": "2001-01-01",
              "inspection_type": "Canvass", "results": "Pass", "violations": "", "ward": "7"}
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p0.json").write_text(json.dumps([record, {**record, "inspection_id": "2", "results": "Fail"}]) + "\n")
    pages, csv, tables = (str(tmp_path / n) for n in ("pages", "csv", "tables"))
    assert main(["store", "--raw", pages, "--out", csv]) == 0
    assert main(["transform", "--raw", csv, "--raw-format", "csv", "--out", tables, "--as-of", AS_OF]) == 0
    assert {r.ward for r in spark.read.parquet(f"{tables}/inspections").collect()} == {"7"}
    assert spark.read.parquet(f"{tables}/risk_scores").count() == 1
