"""Landing order by file names and by manifest; every landed key under a column of its own."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardlens.operators.clean import clean
from hazardlens.operators.profiling import raw_shape
from hazardlens.schemas import RAW_TEXT_COLUMNS
from hazardlens.sources import files as SF
from hazardlens.sources import landed as L
from test_sources import _api, _land


def kept(raw, i="1"):
    return [r.results for r in clean(raw).collect() if r.inspection_id == i]


@pytest.mark.parametrize("first, second", [("page_9.json", "page_10.json"), ("p_99.json", "p_100.json"),
                                           ("offset_50000.json", "offset_100000.json"), ("2024-9-30.json", "2024-10-1.json"),
                                           ("x007.json", "x8.json")])
def test_numbers_in_names_count_as_numbers(spark, tmp_path, first, second):
    _land(tmp_path, first, [_api("1", "Fail")])
    _land(tmp_path, second, [_api("1", "Pass")])
    assert kept(L.read_pages(spark, str(tmp_path))) == ["pass"]


def test_numbered_folders_and_csv_files(spark, tmp_path):
    for n, result in ((9, "Fail"), (10, "Pass")):
        (tmp_path / f"pull_{n}").mkdir()
        _land(tmp_path / f"pull_{n}", "p0.json", [_api("1", result)])
        rows = [_api("1", result, violations="")]
        (tmp_path / f"c_{n}.csv").write_text(",".join(rows[0]) + "\n" + ",".join(rows[0].values()) + "\n")
    assert kept(L.read_pages(spark, str(tmp_path / "pull_*"))) == ["pass"]
    assert kept(SF.read_raw_csv(spark, str(tmp_path / "*.csv"))) == ["pass"]


@pytest.mark.parametrize("names", [("page_1.json", "page_01.json"), ("3fa9c2.json", "b07e11.json"), ("page_9.json", "other_10.json")])
def test_names_without_an_order_are_refused(spark, tmp_path, names):
    for n in names:
        _land(tmp_path, n, [_api("1", "Pass")])
    with pytest.raises(ValueError, match="no landing order"):
        L.read_pages(spark, str(tmp_path))
    with pytest.raises(ValueError, match="positions are needed"):
        L.record_landing(spark, str(tmp_path))


def test_the_manifest_orders_what_names_cannot(spark, tmp_path):
    path = str(tmp_path)
    for name, result in (("b07e11.json", "Fail"), ("3fa9c2.json", "Pass"), ("ff00.json", "Fail")):
        _land(tmp_path, name, [_api("1", result)])
        L.record_landing(spark, path)
    assert kept(L.read_pages(spark, path)) == ["fail"]
    _land(tmp_path, "0a0a.json", [_api("1", "Pass", Zip="9")])
    with pytest.raises(Exception, match="landing order is unknown"):        # landed, but not yet noted
        clean(L.read_pages(spark, path)).collect()
    assert L.record_landing(spark, path) == 4
    assert kept(L.read_pages(spark, path)) == kept(L.read_all_keys(spark, path)) == ["pass"]
    assert sorted((r.file, r.arrival) for r in L.read_manifest(spark, path).collect()) == [
        ("0a0a.json", 4), ("3fa9c2.json", 2), ("b07e11.json", 1), ("ff00.json", 3)]


def test_positions_order_the_files_of_one_arrival(spark, tmp_path, monkeypatch):
    for name, result in (("b07e.json", "Pass"), ("3fa9.json", "Fail")):
        _land(tmp_path, name, [_api("1", result)])
    positions = spark.createDataFrame([("3fa9.json", 50_000), ("b07e.json", 100_000)], "file string, position long")
    with pytest.raises(ValueError, match="no position"):
        L.record_landing(spark, str(tmp_path), positions=positions.limit(1))
    L.record_landing(spark, str(tmp_path), positions=positions)
    assert kept(L.read_pages(spark, str(tmp_path))) == ["pass"]
    monkeypatch.setattr(L, "BROADCAST_FILES", 0)                            # a manifest too large to send along
    assert kept(L.read_pages(spark, str(tmp_path))) == ["pass"]


def test_one_manifest_of_two_folders_is_not_enough(spark, tmp_path):
    for n in ("a", "b"):
        (tmp_path / n).mkdir()
        _land(tmp_path / n, "p1.json", [_api("1", "Pass")])
    L.record_landing(spark, str(tmp_path / "a"))
    with pytest.raises(ValueError, match="some of the landing folders"):
        L.read_pages(spark, [str(tmp_path / "a"), str(tmp_path / "b")])


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.integers(0, 10**25), st.sampled_from(["", "0", "00"]), st.integers(0, 30)), min_size=2, max_size=8))
def test_natural_key_sorts_numbers(spark, items):
    names = [f"dir/page_{zeros}{n}-c{m}.json" for n, zeros, m in items]
    got = spark.createDataFrame([(x,) for x in names], "x string").select("x", L.natural_key(F.col("x")).alias("k")).collect()
    order = {x: (n, m) for x, (n, _, m) in zip(names, items)}
    for a in got:
        for b in got:
            assert (a.k < b.k) == (order[a.x] < order[b.x])


PROBES = {
    "one record per line": ([_api("1", "Pass", extra="x"), _api("2", "Fail", more=5)], {"extra": "extra", "more": "more"}),
    "landing": ([[_api("1", "Pass", landing="dock"), _api("2", "Fail")]], {"landing": "landing_landed"}),
    "a column of a later step": ([_api("1", "Pass", result_score="high"), [_api("2", "Fail")]], {"result_score": "result_score_landed"}),
    "another case": ([[_api("1", "Pass", Zip="60601", zip="1"), _api("2", "Fail", ZIP="3")]], {"Zip": "Zip_landed1", "ZIP": "ZIP_landed"}),
    "establishment_id": ([_api("1", "Pass", establishment_id="E"), _api("2", "Fail")], {"establishment_id": "establishment_id_landed"}),
    "dots and underscores": ([[_api("1", "Pass", **{"a.b": "1", "_rank": "2", ":@computed": "3"}), _api("2", "Fail")]],
                             {"a.b": "a_b_landed", "_rank": "rank_landed", ":@computed": ":@computed"}),
}


@pytest.mark.parametrize("probe", PROBES)
def test_every_landed_key_comes_back(spark, tmp_path, probe):
    lines, renamed = PROBES[probe]
    renamed = {k: "Zip_landed2" if c == "Zip_landed1" else c for k, c in renamed.items()}
    _land(tmp_path, "p0.json", *lines)
    raw = L.read_all_keys(spark, str(tmp_path))
    assert set(raw.columns) == {*RAW_TEXT_COLUMNS, *renamed.values(), "landing"}
    shape = raw_shape(raw.drop("landing")).first()
    assert set(shape["columns"].split(",")) == {*RAW_TEXT_COLUMNS, *renamed.values()} and shape.n_rows == 2
    records = {r["inspection_id"]: r for x in lines for r in (x if isinstance(x, list) else [x])}
    out = clean(raw)
    assert len({c.lower() for c in out.columns}) == len(out.columns)        # no two columns of one name
    for r in out.collect():
        for key, column in renamed.items():
            value = records[r.inspection_id].get(key)
            assert r[column] == (None if value is None else str(value))


def test_clashing_keys_go_through_the_whole_job(spark, tmp_path):
    from hazardlens.__main__ import main
    (tmp_path / "pages").mkdir()
    _land(tmp_path / "pages", "p0.json", _api("1", "Pass", Zip="z", landing="l", result_score="s", establishment_id="e"),
          _api("2", "Fail", nested={"a": 1}))
    assert main(["transform", "--raw", str(tmp_path / "pages"), "--out", str(tmp_path / "t"), "--as-of", "2001-09-01 12:00:00"]) == 0
    rows = {r.inspection_id: r for r in spark.read.parquet(str(tmp_path / "t" / "inspections")).collect()}
    assert (rows["1"].Zip_landed, rows["1"].landing_landed, rows["1"].result_score_landed, rows["1"].establishment_id_landed) == ("z", "l", "s", "e")
    assert json.loads(rows["2"].nested) == {"a": 1} and rows["1"].establishment_id == "L" and rows["1"].result_score == 0.0


def test_damaged_records_are_refused_among_clashing_keys(spark, tmp_path):
    _land(tmp_path, "p0.json", [_api("1", "Pass", Zip="1")])
    (tmp_path / "p1.json").write_text('[{"inspection_id": "2", "Zip": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        L.read_all_keys(spark, str(tmp_path)).collect()


def test_csv_columns_that_clash_are_renamed(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("inspection_id,results,dba_name,address,license_,inspection_date,inspection_type,violations,"
                                      "result_score,landing,a.b\n1,Pass,n,a,L,2001-01-01,Canvass,,9,dock,7\n")
    out = clean(SF.read_raw_csv(spark, str(tmp_path / "raw.csv"))).first()
    assert (out.result_score_landed, out.landing_landed, out.a_b_landed, out.result_score) == ("9", "dock", "7", 0.0)


def test_a_stored_page_is_a_range_read(spark):
    from hazardlens.session import staging_path
    from hazardlens.sources.fixtures import raw_inspections
    from conftest import SF_SMALL
    raw = raw_inspections(spark, SF_SMALL)
    path = L.store_pages(raw, staging_path(spark, "t-stored"), 100)
    rows = sorted(tuple(r) for r in raw.select("inspection_id", "ingest_seq").collect())
    for page in (0, 7, len(rows) // 100, 99):
        df = L.stored_page(spark, path, page)
        assert df.columns == raw.columns
        assert [(r.inspection_id, r.ingest_seq) for r in df.collect()] == rows[100 * page:100 * page + 100]
    plan = L.stored_page(spark, path, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(page_no), EqualTo(page_no,7)]" in plan and "Join" not in plan and "Window" not in plan
    # the files hold disjoint ranges of rows, so the statistics of all but one or two exclude a page
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("row_index").alias("a"), F.max("row_index").alias("b")).collect()
    ranges = sorted((r.a, r.b) for r in files)
    assert all(x[1] < y[0] for x, y in zip(ranges, ranges[1:]))
