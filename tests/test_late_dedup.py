"""C6 by late materialisation, the one-scan histogram and the transform job's passes."""

import pytest
from pyspark.sql import functions as F

from conftest import AS_OF, SF_SMALL
from hazardlens.operators import clean as C
from hazardlens.operators import serving as D
from hazardlens.schemas import RAW_TEXT_COLUMNS
from hazardlens.session import staged, staging_path
from hazardlens.sources import landed as L
from hazardlens.sources.fixtures import raw_inspections


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def stored(spark):
    return staged(raw_inspections(spark, SF_SMALL), "t-late")


def test_no_violation_text_is_shuffled(spark, stored):
    repeated = C.repeated_ids(C.usable_records(stored))
    cleaned = C.clean(stored, repeated=repeated)
    plan = _plan(cleaned)
    assert "violations" in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    assert 0 < repeated.count() < stored.count() / 20
    narrow = C.usable_records(stored).groupBy("inspection_id").agg(F.max("ingest_seq"))
    assert "violations" not in _plan(narrow)
    assert _rows(cleaned) == _rows(C.clean(stored))


def test_landed_pages_are_read_twice_alike(spark, stored, tmp_path):
    """The landing order of a record is the same in the narrow and in the whole pass, over several splits."""
    path = str(tmp_path / "pages")
    for n, seq in ((9, 0), (10, 1)):
        L.land_pages(stored.filter(F.col("ingest_seq") == seq), f"{path}/pull_{n}", 100, RAW_TEXT_COLUMNS)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60k")
    try:
        raw = L.read_pages(spark, f"{path}/*")
        cleaned = C.clean(raw, repeated=C.repeated_ids(C.usable_records(raw)))
        assert _rows(cleaned.drop("landing")) == _rows(C.clean(raw).drop("landing"))
        assert cleaned.filter("results = 'fail'").count() > 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_hot_copies_null_ids_and_unknown_orders(spark, stored):
    hot = stored.withColumn("ingest_seq", F.monotonically_increasing_id()).withColumn(
        "inspection_id", F.when(F.crc32("inspection_id") % 3 == 0, "X").when(F.crc32("inspection_id") % 7 == 0, None)
        .otherwise(F.col("inspection_id")))
    hot = staged(hot, "t-late-hot")
    assert _rows(C.dedup_late(hot)) == _rows(C.dedup_keep_last(hot))
    assert C.dedup_late(hot).filter("inspection_id IS NULL").count() == 1
    with pytest.raises(Exception, match="landing order is unknown"):
        C.dedup_late(hot.withColumn("ingest_seq", F.lit(None).cast("long")))
    assert C.dedup_late(hot.drop("inspection_id")).count() == hot.count()


def test_too_many_repeated_ids_take_the_group_limit(spark, stored, monkeypatch):
    monkeypatch.setattr(C, "REPEATED_IDS", 3)
    late = C.dedup_late(C.usable_records(stored))
    assert "WindowGroupLimit" in _plan(late) and _rows(late) == _rows(C.dedup_keep_last(C.usable_records(stored)))


def test_histogram_scans_the_scores_once(spark):
    path = staging_path(spark, "t-hist")
    spark.range(5000).select((F.crc32(F.col("id").cast("string")) % 765 / 10.0).alias("dynamic_risk_score")).write.parquet(path)
    hist = D.score_histogram(spark.read.parquet(path))
    plan = _plan(hist)
    assert plan.split("== Initial Plan ==")[0].count("FileScan") == 1 and "Subquery" not in plan and len(plan) < 12_000
    assert sum(r.establishments for r in hist.collect()) == 5000


def test_reports_of_the_transform_job(spark, stored, tmp_path):
    from hazardlens.operators.signals import severity_stats, signal_report, signal_totals
    from hazardlens.plans.batch import run_transform
    res = run_transform(spark, stored, AS_OF, out_dir=str(tmp_path / "t"))
    report = signal_report(res.inspections).first().asDict()
    assert report == {"n_rows": res.inspections.count(), **signal_totals(res.inspections).first().asDict(),
                      **severity_stats(res.inspections).first().asDict()}
    assert {k: res.counters[k] for k in report if k != "n_rows"} == {k: v for k, v in report.items() if k != "n_rows"}
    assert res.counters["n_establishments"] == res.scores.count() == C.count_establishments(res.inspections).first()[0]
