"""Landed pages, paging, CSV round trip, source fallback."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import ROOT, SF_SMALL
from hazardlens.schemas import RAW, SCORES
from hazardlens.session import staging_path
from hazardlens.sinks.writers import write_csv
from hazardlens.sources import files as SF
from hazardlens.sources import landed as L
from hazardlens.sources.fixtures import raw_inspections


def test_assign_pages_matches_global_row_number(spark):
    raw = raw_inspections(spark, SF_SMALL).repartition(5)
    got = {(r.inspection_id, r.ingest_seq): (r.row_index, r.page_no)
           for r in L.assign_pages(raw, 97).select("inspection_id", "ingest_seq", "row_index", "page_no").collect()}
    w = Window.orderBy(F.col("inspection_id").asc_nulls_first(), F.col("ingest_seq").asc_nulls_first())
    ref = raw.withColumn("rn", F.row_number().over(w) - 1).select("inspection_id", "ingest_seq", "rn").collect()
    assert len(got) == len(ref)
    for r in ref:
        assert got[(r.inspection_id, r.ingest_seq)] == (r.rn, r.rn // 97)


def test_pages_round_trip(spark):
    raw = raw_inspections(spark, SF_SMALL)
    path = L.land_pages(raw, staging_path(spark, "t-pages"), 200)
    back = L.read_pages(spark, path, L.page_schema(with_seq=True))
    assert sorted(map(tuple, back.drop("landing").collect())) == sorted(map(tuple, raw.collect()))
    per_file = spark.read.text(path).groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 200       # no more than a page to a file
    # the landing order is the order of the records, over all files
    landed = [(r.inspection_id, r.ingest_seq) for r in back.orderBy("landing").collect()]
    assert landed == sorted(landed)


def test_union_pages_missing_keys(spark):
    raw = raw_inspections(spark, SF_SMALL)
    seq = L.page_schema(with_seq=True)
    a = L.read_pages(spark, L.land_pages(raw.filter("ingest_seq = 0"), staging_path(spark, "t-a"), 500), seq)
    narrow = T.StructType([f for f in RAW.fields if f.name not in ("aka_name", "zip")])
    cols = narrow.fieldNames()
    b = L.read_pages(spark, L.land_pages(raw.filter("ingest_seq = 1"), staging_path(spark, "t-b"), 500, cols), narrow)
    u = L.union_pages([a, b])
    assert set(u.columns) == {*RAW.fieldNames(), "landing"}
    assert u.filter("ingest_seq = 1 AND (aka_name IS NOT NULL OR zip IS NOT NULL)").count() == 0
    assert u.count() == raw.count()


def test_csv_round_trip_keeps_text_exact(spark):
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.StringType())])
    rows = [("a", ""), ("b", None), ("c", "  padded  "), ("d", 'say "hi"\nnext line, comma'), ("e", "\\")]
    df = spark.createDataFrame(rows, schema)
    path = staging_path(spark, "t-csv")
    write_csv(df, path)
    assert sorted(SF.read_csv(spark, path, schema).collect()) == sorted(df.collect())


def test_source_fallback(spark, tmp_path):
    empty = SF.table_or_path(spark, "no_such_table_here", None, SCORES, optional=True)
    assert empty.count() == 0 and empty.schema == SCORES
    assert SF.table_or_path(spark, None, "/tmp/definitely/not/here", SCORES, optional=True).count() == 0
    for missing in (None, "/tmp/definitely/not/here"):              # the scores must be there
        with pytest.raises(FileNotFoundError):
            SF.table_or_path(spark, "no_such_table_here", missing, SCORES)
    (tmp_path / "broken.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet"):             # damaged is not absent
        SF.table_or_path(spark, None, str(tmp_path), SCORES, optional=True).collect()
    with pytest.raises(Exception):                                  # an unknown driver is no lost connection
        SF.table_or_path(spark, "t", None, SCORES, jdbc_url="jdbc:nosuchdriver:x", jdbc_partition=("k", "0", "9", 2))
    with pytest.raises(ValueError):                                 # one task may not read a whole table
        SF.table_or_path(spark, "t", None, SCORES, jdbc_url="jdbc:nosuchdriver:x")


def _land(tmp_path, name, *pages):
    import json
    (tmp_path / name).write_text("".join(json.dumps(p) + "\n" for p in pages))


def _api(i, result, name="zzz", **more):
    return {"inspection_id": i, "dba_name": name, "address": "a", "license_": "L", "inspection_date": "2001-01-01",
            "inspection_type": "Canvass", "results": result, **more}


@pytest.mark.parametrize("pages", [
    {"p0.json": [[_api("1", "Fail"), _api("1", "Pass", "aaa")]]},                                       # one page
    {"p0.json": [[_api("1", "Fail")], [_api("1", "Pass", "aaa")]]},                                     # two pages of a file
    {"p0.json": [[_api("1", "Fail")]], "p1.json": [[_api(str(i), "Fail") for i in range(2, 300)], [_api("1", "Pass", "aaa")]]}])
def test_the_last_landed_record_is_kept(spark, tmp_path, pages):
    from hazardlens.operators.clean import clean
    for name, content in pages.items():
        _land(tmp_path, name, *content)
    got = [r for r in clean(L.read_pages(spark, str(tmp_path))).collect() if r.inspection_id == "1"]
    assert [r.results for r in got] == ["pass"]


def test_landing_order_survives_splits(spark, tmp_path):
    _land(tmp_path, "p0.json", *[[_api(str(100 * i + j), "Pass") for j in range(100)] for i in range(60)])
    _land(tmp_path, "p1.json", *[[_api(str(6000 + j), "Pass")] for j in range(10)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        raw = L.read_pages(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 5
        assert [int(r.inspection_id) for r in raw.orderBy("landing").collect()] == list(range(6010))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_damaged_page_is_never_lost_unnoticed(spark, tmp_path):
    _land(tmp_path, "p0.json", [_api(str(i), "Pass") for i in range(100)])
    whole = (tmp_path / "p0.json").read_text()
    (tmp_path / "p1.json").write_text(whole[:-30] + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        L.read_pages(spark, str(tmp_path)).collect()
    bad = L.damaged_pages(spark, str(tmp_path)).collect()
    assert [(r.file.rsplit("/", 1)[1], r.page) for r in bad] == [("p1.json", whole[:-30])]


def test_a_null_landing_order_is_refused(spark):
    from hazardlens.operators.clean import clean
    raw = spark.createDataFrame([tuple(_api("1", "Pass").values())], list(_api("1", "Pass"))).withColumn("violations", F.lit(""))
    with pytest.raises(Exception, match="landing order is unknown"):
        clean(raw).collect()


def test_undeclared_keys_pass_through(spark, tmp_path):
    from hazardlens.operators.profiling import raw_shape
    _land(tmp_path, "p0.json", [_api("1", "Pass", ward=7)], [_api("2", "Fail", extra="x")])
    keys = L.landed_keys(spark, str(tmp_path))
    assert keys[-2:] == ["extra", "ward"] and "violations" not in keys
    raw = L.read_pages(spark, str(tmp_path), L.page_schema(["extra", "ward"]))
    assert {(r.inspection_id, r.extra, r.ward) for r in raw.collect()} == {("1", None, "7"), ("2", "x", None)}
    assert "ward" in raw_shape(raw.drop("landing")).first()["columns"].split(",")


def test_multi_file_csv_keeps_the_later_file(spark, tmp_path):
    from hazardlens.operators.clean import clean
    head = "inspection_id,results,dba_name,address,license_,inspection_date,inspection_type,violations,ward\n"
    (tmp_path / "a.csv").write_text(head + "1,Fail,z,a,L,2001-01-01,Canvass,,5\n")
    (tmp_path / "b.csv").write_text(head + "".join(f"{i},Pass,n,a,L,2001-01-01,Canvass,,6\n" for i in range(2, 3000)) + "1,Pass,a,a,L,2001-01-01,Canvass,,7\n")
    raw = SF.read_raw_csv(spark, str(tmp_path))
    got = [r for r in clean(raw).collect() if r.inspection_id == "1"]
    assert [(r.results, r.ward) for r in got] == [("pass", "7")]
    (tmp_path / "c.csv").write_text(head.replace("inspection_id,results", "results,inspection_id") + "Pass,1,z,a,L,2001-01-01,Canvass,,5\n")
    with pytest.raises(Exception, match="(?i)header"):              # columns in another order are refused, not misread
        SF.read_raw_csv(spark, str(tmp_path)).collect()


def test_pages_alike_at_every_depth(spark):
    raw = raw_inspections(spark, SF_SMALL)
    rows = sorted((r.inspection_id, r.ingest_seq) for r in raw.select("inspection_id", "ingest_seq").collect())
    for page in (0, 3, len(rows) // 100, 99):
        got = [tuple(r) for r in L.ordered_page(raw, page, 100).select("inspection_id", "ingest_seq").collect()]
        assert got == rows[100 * page:100 * page + 100]


def test_paging_and_ranks_in_a_bare_session():
    """Both in a session with no checkpoint folder and no other query before."""
    import subprocess
    import sys
    code = """
import sys; sys.path.insert(0, %r)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
from hazardlens.plans.registry import queries
for q in ("page_assignment", "inspection_order"):
    print(q, queries()[q](spark, %r).count())
""" % (ROOT, SF_SMALL)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "page_assignment" in out.stdout and "inspection_order" in out.stdout, out.stderr[-2000:]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from hazardlens.session import checkpoint_root
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=context, conf={}))


def test_spread_is_noop_on_well_split_input(spark):
    from hazardlens.session import spread
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread(many, "id") is many                      # no added exchange at scale
    one = spark.range(0, 1000, numPartitions=1)
    spread_one = spread(one, "id")
    assert spread_one.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.id for r in spread_one.collect()) == list(range(1000))


def test_raw_csv_maps_columns_by_header(spark, tmp_path):
    from hazardlens.operators.clean import clean
    csv = tmp_path / "raw.csv"
    csv.write_text(
        'results,license_,extra_col,inspection_id,dba_name,address,inspection_date,inspection_type,violations\n'
        'Pass,L1,zzz,7,"Joe\'s, ""Grill""","1 N ST",2001-01-01T00:00:00.000,Canvass,\n'
        'Fail,L1,zzz,7,Joe\'s,"1 N ST",2001-01-02T00:00:00.000,Complaint,"3. a\n| 15. b"\n')
    raw = SF.read_raw_csv(spark, str(csv))
    assert raw.columns == [*(c for c in RAW.fieldNames() if c != "ingest_seq"), "extra_col", "landing"]
    rows = raw.orderBy("landing").collect()
    assert [r.results for r in rows] == ["Pass", "Fail"] and rows[0].dba_name == 'Joe\'s, "Grill"'
    assert rows[0].aka_name is None and rows[1].violations == "3. a\n| 15. b"
    out = clean(raw).collect()                       # keep-last = the later row of the file
    assert len(out) == 1 and out[0].results == "fail"


def test_csv_by_header_casts_and_nulls(spark, tmp_path):
    from hazardlens.schemas import SCORES
    csv = tmp_path / "scores.csv"
    csv.write_text("dynamic_risk_score,establishment_id,total_inspections,last_inspection_date,zip,latitude\n"
                   "55.3,L1,4,2001-08-01 00:00:00,,41.5\n"
                   "n/a,L2,,2001-08-02T10:00:00,60601,bad\n")
    df = SF.read_csv_by_header(spark, str(csv), SCORES)
    assert df.schema == SCORES
    r = {x.establishment_id: x for x in df.collect()}
    assert r["L1"].dynamic_risk_score == 55.3 and r["L1"].total_inspections == 4 and r["L1"].zip is None
    assert r["L2"].dynamic_risk_score is None and r["L2"].latitude is None and r["L2"].zip == "60601"
    assert str(r["L2"].last_inspection_date) == "2001-08-02 10:00:00" and r["L1"].aka_name is None


def test_fallback_reads_our_csv(spark):
    from hazardlens.sinks.writers import write_csv
    rows = [("L1", 55.3)]
    df = spark.createDataFrame(rows, "establishment_id string, dynamic_risk_score double")
    path = staging_path(spark, "fallback-csv")
    write_csv(df, path)
    got = SF.table_or_path(spark, None, path, SCORES, fmt="csv").collect()
    assert len(got) == 1 and got[0].dynamic_risk_score == 55.3 and got[0].zip is None
    assert SF.table_or_path(spark, None, "/tmp/not/here.csv", SCORES, fmt="csv", optional=True).count() == 0


def test_read_api_dump_multiline(spark, tmp_path):
    import json
    page = [{"inspection_id": "1", "dba_name": "A", "results": "Pass", "extra": {"nested": 1}},
            {"inspection_id": "2", "dba_name": "B", "license_": "L2"}]
    (tmp_path / "page0.json").write_text(json.dumps(page, indent=2))
    rows = sorted(L.read_pages(spark, str(tmp_path), multiline=True).collect(), key=lambda r: r.inspection_id)
    assert [r.dba_name for r in rows] == ["A", "B"] and rows[0].license_ is None and rows[1].results is None


def test_recommended_conf_scales_with_input():
    from hazardlens.session import recommended_conf
    big = recommended_conf(100 * 1024 ** 4, 8000)          # 100 TB on 8,000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = recommended_conf(1024 ** 2, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert big["spark.sql.adaptive.enabled"] == "true"
