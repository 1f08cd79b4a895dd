"""Snapshots of both tables, and the refresh that rewrites only touched buckets."""

import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, SF_SMALL
from hazardlens.operators import serving as D
from hazardlens.plans.batch import transform
from hazardlens.plans.dashboard import Dashboard
from hazardlens.session import staging_path
from hazardlens.sinks import snapshots as S
from hazardlens.sources.fixtures import raw_inspections
from hazardlens.streaming import incremental as I
from hazardlens.streaming.refresh import latest_output, start_refresh


@pytest.fixture(scope="module")
def tables(spark):
    insp, scores = transform(raw_inspections(spark, SF_SMALL), AS_OF)
    return insp.drop("kw_found", "violation_codes").cache(), scores.cache()


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _local(path):
    return path.removeprefix("file:")


def test_a_reader_from_before_a_refresh_finishes_after_it(spark, tables):
    insp, scores = tables
    base = staging_path(spark, "snap")
    assert S.current(spark, base) is None
    S.publish(insp, scores, base)
    held = S.current(spark, base)
    reading = held.read(spark, "inspections")
    S.publish(insp.limit(10), scores.limit(3), base)
    assert (reading.count(), held.read(spark, "risk_scores").count()) == (insp.count(), scores.count())
    now = S.current(spark, base)
    assert (now.version, now.read(spark, "inspections").count(), now.read(spark, "risk_scores").count()) == (2, 10, 3)
    S.publish(insp.limit(4), scores.limit(2), base, keep=2, keep_seconds=0)       # the first one goes, the second stays
    assert S.versions(spark, base) == [2, 3] and now.read(spark, "inspections").count() == 10
    assert all(len(os.listdir(f"{_local(base)}/{t}")) == 2 for t in ("inspections", "risk_scores"))


def test_refused_tables_leave_no_snapshot(spark, tables):
    insp, scores = tables
    base = staging_path(spark, "snap-refused")
    S.publish(insp, scores, base)
    for bad in ((insp.unionByName(insp.limit(1)), scores), (insp, scores.unionByName(scores.limit(1)))):
        with pytest.raises(ValueError, match="duplicate values"):
            S.publish(*bad, base)
    assert S.versions(spark, base) == [1] and len(os.listdir(f"{_local(base)}/inspections")) == 1
    with pytest.raises(FileExistsError):
        S.commit(spark, base, 1, {})
    assert sorted(n for n in os.listdir(f"{_local(base)}/_commits") if not n.startswith(".")) == ["0000000001.json"]


def test_dashboard_holds_one_snapshot(spark, tables):
    insp, scores = tables
    base = staging_path(spark, "snap-dash")
    S.publish(insp, scores, base)
    dash = Dashboard(spark, base, ttl=3600)
    cached = dash.scores
    assert cached.count() == scores.count()
    S.publish(insp.limit(10), scores.limit(3), base)
    spark.catalog.clearCache()                                    # lost blocks are read again from the held files
    assert dash.scores.count() == scores.count() and dash.inspections.count() == insp.count()
    dash.ttl = 0
    assert dash.scores.count() == 3 and dash.inspections.count() == 10
    D.release_cached(spark)


def _page(i, result, name, licence, date="2001-01-01"):
    return {"inspection_id": i, "dba_name": name, "address": "a", "license_": licence, "inspection_date": date,
            "inspection_type": "Canvass", "results": result, "violations": "1. RATS"}


def _files(base, table):
    return {f"{d}/{f}": os.stat(f"{d}/{f}").st_mtime_ns for d, _, fs in os.walk(f"{base}/{table}") for f in fs if f.endswith(".parquet")}


def test_a_batch_rewrites_only_what_it_touches(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "out")
    landing.mkdir()

    def drop(name, *records):
        (landing / name).write_text(json.dumps(records) + "\n")
        start_refresh(spark, str(landing), f"{tmp_path}/raw", out, f"{tmp_path}/ckpt", AS_OF, buckets=16,
                      keep=2, keep_seconds=0).awaitTermination(300)
        inspections, scores = latest_output(spark, out)
        landed = spark.read.parquet(f"{tmp_path}/raw/_parsed")
        # against the scores of everything that is stored, and the stored against the last record of each id
        last = landed.groupBy("inspection_id").agg(F.max_by("results", "_batch").alias("results"))
        assert _rows(inspections.select("inspection_id", "results")) == _rows(last)
        from hazardlens.operators.scoring import risk_scores
        assert _rows(scores) == _rows(risk_scores(inspections, AS_OF).select(scores.columns))
        return {r.establishment_id: r for r in scores.collect()}, S.current(spark, out)

    records = [_page(str(i), "Fail" if i % 3 else "Pass", f"n{i % 40}", f"L{i % 40}", f"2001-01-{i % 28 + 1:02d}") for i in range(400)]
    scores, first = drop("d1.json", *records)
    assert len(scores) == 40 and len(first.tables["inspections"]) > 8
    before = _files(out, "inspections")

    # a correction that lowers a count, and takes a record away from one establishment to another
    scores2, second = drop("d2.json", _page("41", "Pass", "n1", "L1"), _page("82", "Fail", "n3", "L3"))
    keys = {k[-2:]: k for k in scores if k.endswith(("L1", "L2", "L3"))}
    one, two, three = (keys[k] for k in ("L1", "L2", "L3"))
    assert scores2[one].total_failures == scores[one].total_failures - 1
    assert scores2[two].total_inspections == scores[two].total_inspections - 1
    assert scores2[three].total_inspections == scores[three].total_inspections + 1
    shared = set(first.tables["inspections"]) & set(second.tables["inspections"])
    assert len(set(first.tables["inspections"]) - shared) <= 3 and len(shared) > 5
    after = _files(out, "inspections")
    assert all(after[f] == t for f, t in before.items())          # no file of the first snapshot was touched
    assert set(first.tables["state"]) & set(second.tables["state"]) and first.read(spark, "inspections").count() == 400

    _, third = drop("d3.json", _page("41", "Fail", "n1", "L1"))
    assert S.versions(spark, out) == [2, 3]                       # the first is gone, but not the files that are shared
    assert len(_files(out, "inspections")) < len(after) + 3
    again = I.refresh(spark, spark.read.parquet(f"{tmp_path}/raw/_parsed").limit(0), out, AS_OF, 3, 16, writer=f"{tmp_path}/ckpt")
    assert again.tables == third.tables                           # a retried batch changes nothing
    with pytest.raises(ValueError, match="another writer"):
        I.refresh(spark, spark.read.parquet(f"{tmp_path}/raw/_parsed"), out, AS_OF, 3, 16, writer="x")
    with pytest.raises(ValueError, match="16 buckets"):
        I.refresh(spark, spark.read.parquet(f"{tmp_path}/raw/_parsed"), out, AS_OF, 4, 8, writer=f"{tmp_path}/ckpt")


def test_nothing_usable_and_null_keys(spark, tmp_path):
    from hazardlens.schemas import INSPECTIONS
    base = str(tmp_path)
    empty = spark.createDataFrame([], INSPECTIONS)
    I.refresh(spark, empty, base, AS_OF, 1, 4)
    inspections, scores = latest_output(spark, base)
    assert (inspections.count(), scores.count(), len(inspections.columns)) == (0, 0, len(INSPECTIONS))
    values = dict.fromkeys(INSPECTIONS.fieldNames())
    import datetime
    a = {**values, "establishment_id": "E", "inspection_date": datetime.datetime(2001, 1, 1), "result_score": 1.0, "violation_severity": 1.0}
    I.refresh(spark, spark.createDataFrame([a, {**a, "inspection_id": "2", "establishment_id": None}], INSPECTIONS), base, AS_OF, 2, 4)
    I.refresh(spark, spark.createDataFrame([{**a, "result_score": 0.0}], INSPECTIONS), base, AS_OF, 3, 4)
    inspections, scores = latest_output(spark, base)
    assert inspections.count() == 2 and [(r.total_failures, r.total_passes) for r in scores.collect()] == [(0, 1)]
    I.refresh(spark, empty, base, AS_OF, 4, 4)                    # only the clock moves: no bucket is written
    assert S.current(spark, base).tables["inspections"] == S.load(spark, base, 3).tables["inspections"]
