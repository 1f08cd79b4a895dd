"""Refresh-on-arrival stream: output equals the batch transform of everything landed."""

import json

import pytest

from conftest import AS_OF, SF_SMALL
from hazardlens.operators.clean import clean
from hazardlens.plans.batch import transform
from hazardlens.schemas import RAW_TEXT_COLUMNS
from hazardlens.session import staging_path
from hazardlens.sources import landed as L
from hazardlens.sources.fixtures import raw_inspections
from hazardlens.streaming.refresh import latest_output, start_refresh


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_refresh_on_arrival(spark):
    raw = raw_inspections(spark, SF_SMALL)
    landing = staging_path(spark, "landing")
    raw_dir, out_dir, ckpt = (staging_path(spark, n) for n in ("raw", "out", "ckpt"))

    L.land_pages(raw.filter("ingest_seq = 0"), f"{landing}/drop1", 300, RAW_TEXT_COLUMNS)
    q = start_refresh(spark, landing, raw_dir, out_dir, ckpt, AS_OF)
    q.awaitTermination(300)
    _, scores1 = latest_output(spark, out_dir)
    _, expect1 = transform(raw.filter("ingest_seq = 0"), AS_OF)
    assert _rows(scores1) == _rows(expect1.select(scores1.columns))

    # The re-sent copies land later; the next run picks up only the new files.
    L.land_pages(raw.filter("ingest_seq = 1"), f"{landing}/drop2", 300, RAW_TEXT_COLUMNS)
    q = start_refresh(spark, landing, raw_dir, out_dir, ckpt, AS_OF)
    q.awaitTermination(300)
    insp2, scores2 = latest_output(spark, out_dir)
    exp_insp, expect2 = transform(raw, AS_OF)
    assert _rows(scores2) == _rows(expect2.select(scores2.columns))
    assert insp2.count() == exp_insp.count()
    assert spark.read.parquet(f"{raw_dir}/_landed").count() == raw.count()
    # each batch parsed only its own records
    parsed = spark.read.parquet(f"{raw_dir}/_parsed")
    assert parsed.filter("_batch = 1").count() == clean(raw.filter("ingest_seq = 1")).count()


def test_readers_skip_incomplete_batch(spark):
    out = staging_path(spark, "out-partial")
    one = spark.createDataFrame([(1,)], "x int")
    for b in (1, 2):
        one.write.parquet(f"{out}/batch={b:010d}/inspections")
        spark.createDataFrame([(b,)], "x int").write.parquet(f"{out}/batch={b:010d}/risk_scores")
    spark.createDataFrame([(1,)], "batch_id long").write.json(f"{out}/batch={1:010d}/_BATCH_COMPLETE")
    _, scores = latest_output(spark, out)          # batch 2 has no completion marker
    assert scores.first().x == 1


def _page(i, result, name, date="2001-01-01"):
    return {"inspection_id": i, "dba_name": name, "address": "a", "license_": "L" + i, "inspection_date": date,
            "inspection_type": "Canvass", "results": result}


def _drop(landing, name, *records):
    import os
    os.makedirs(landing, exist_ok=True)
    with open(f"{landing}/{name}", "w") as f:
        f.write(json.dumps(records) + "\n")


def _run(spark, tmp_path, **more):
    start_refresh(spark, f"{tmp_path}/landing", f"{tmp_path}/raw", f"{tmp_path}/out", f"{tmp_path}/ckpt", AS_OF,
                  **more).awaitTermination(300)
    inspections, scores = latest_output(spark, f"{tmp_path}/out")
    return {r.inspection_id: r.results for r in inspections.collect()}, scores.count()


def test_unusable_first_drop_then_corrections(spark, tmp_path):
    """Nothing usable at first; then records; then a correction whose content sorts lower; then an older copy again."""
    landing = f"{tmp_path}/landing"
    _drop(landing, "d1.json", _page("1", "No Entry", "n"), _page("2", "Pass", "n", date="bad"))
    assert _run(spark, tmp_path) == ({}, 0)
    _drop(landing, "d2.json", _page("1", "Fail", "zzz"), _page("2", "Pass", "n"), _page("3", "Fail", "x"))
    assert _run(spark, tmp_path) == ({"1": "fail", "2": "pass", "3": "fail"}, 3)
    _drop(landing, "d3.json", _page("1", "Fail", "zzz"), _page("1", "Pass", "aaa"))
    assert _run(spark, tmp_path) == ({"1": "pass", "2": "pass", "3": "fail"}, 3)
    _drop(landing, "d4.json", _page("1", "Fail", "aaa"), _page("3", "Out of Business", "x"))
    assert _run(spark, tmp_path) == ({"1": "fail", "2": "pass", "3": "fail"}, 3)
    kept = [p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("batch=")]
    assert sorted(kept) == ["batch=0000000002", "batch=0000000003"]          # older outputs are removed


def test_a_damaged_drop_stops_the_stream(spark, tmp_path):
    _drop(f"{tmp_path}/landing", "d1.json", _page("1", "Pass", "n"))
    path = tmp_path / "landing" / "d1.json"
    path.write_text(path.read_text()[:-10])
    with pytest.raises(Exception, match="(?i)malformed"):
        _run(spark, tmp_path)
    assert latest_output(spark, f"{tmp_path}/out") is None
