"""Steps whose cost a finding named: done once, and no larger for one task as the data grow."""

import re
from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SF_SMALL, raw_rows, record
from hazardlens.config import DEFAULT_CONFIG
from hazardlens.functions import violations as V
from hazardlens.operators import scoring as R
from hazardlens.operators.clean import clean
from hazardlens.operators.signals import parse_violations
from hazardlens.plans import registry
from hazardlens.session import staging_path
from hazardlens.sinks import layout as LY
from hazardlens.sinks import writers as K
from hazardlens.sources import files as SF
from hazardlens.sources import landed as L
from test_registry_plans import executed_plans

PARSING = re.compile(r"regexp_extract_all\(", re.I)          # the violation codes: only the parse has it


def _parses(plans):
    """Executed plans that parse the texts."""
    return sum(bool(PARSING.search(p)) for p in plans if "isFinalPlan=true" in p)


def _run(spark, name):
    with executed_plans(spark) as plans:
        registry.queries()[name](spark, SF_SMALL).collect()
    return plans


def test_texts_are_parsed_once(spark):
    """The inspections are stored before both tables are made of them."""
    for name in ("refresh_snapshots", "catalog_scan", "refresh_tables", "inspection_history"):
        assert _parses(_run(spark, name)) == 1, name


def test_layouts_store_their_rows_before_they_look_for_ranges(spark):
    """neither the boundaries nor the range exchange derive the rows again."""
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    insp = parse_violations(clean(raw_rows(spark, [record(inspection_id=str(i), zip=str(60600 + i % 7)) for i in range(50)])))
    LY.dated(insp.drop("kw_found", "violation_codes").mapInArrow(counted, insp.drop("kw_found", "violation_codes").schema),
             staging_path(spark, "t-dated"))
    assert calls.value == 50
    scores = R.risk_scores(insp, "2001-09-01 12:00:00").withColumn("establishment_id", F.col("dba_name"))
    many = scores.crossJoin(spark.range(40).select(F.col("id").cast("string").alias("n"))).withColumn(
        "establishment_id", F.col("n")).drop("n")
    path = staging_path(spark, "t-zordered")
    LY.zordered(many.mapInArrow(counted, many.schema), path)
    assert calls.value == 90 and spark.read.parquet(path).count() == 40


def test_raw_records_are_derived_once(spark):
    """every drop is landed from the stored records."""
    for name in ("dedup_csv_files", "dedup_numbered_pages", "dedup_landed_pages", "incremental_refresh", "streaming_refresh"):
        deriving = [p for p in _run(spark, name) if "lineitem.parquet" in p and "isFinalPlan=true" in p]
        assert len(deriving) == 1, name


def test_csv_files_are_bounded(spark, tmp_path):
    """a multi-line file is read by one task, so a file's records are bounded and order is kept over files."""
    df = spark.range(0, 2500, 1, 2).select(F.col("id").cast("string").alias("inspection_id"), F.lit("a\nb, \"c\"").alias("results"))
    path = staging_path(spark, "t-bounded")
    K.write_csv(df, path, max_records=300)
    back = SF.read_raw_csv(spark, path, null_value="\\N")
    sizes = [r["n"] for r in back.groupBy("landing.file").agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) <= 300 and sum(sizes) == 2500
    assert [int(r.inspection_id) for r in back.orderBy("landing").collect()] == list(range(2500))
    plans = _run(spark, "dedup_csv_files")
    assert not any(re.search(r"hashpartitioning\(inspection_id#\d+, 3\)", p) for p in plans)


def test_keywords_are_found_in_one_reading(spark):
    """One pattern over the text finds what a search for every keyword finds, whatever the lists."""
    tiers = {"critical": ["rat", "rats", "e. coli", "x"], "major": ["at", "tar", "rat", "(a|b)[c]^"], "minor": ["temperature", "cat", "é\U0001f400"]}
    cfg = replace(DEFAULT_CONFIG, keyword_tiers=tiers)
    texts = ["", "temperature", "rats at e. coli", "e.coli cats", "tarat", "(a|b)[c]^é\U0001f400x", "RATS", "ra ts\nrat", "xx"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, t string")
    for c in (cfg, DEFAULT_CONFIG):
        kw = V.keyword_scan("p", c)
        for r in df.withColumn("p", V.keyword_places(V.lowered_text("t"), c)).select("t", *(kw[t].alias(t) for t in kw)).collect():
            assert {t: r[t] for t in kw} == {t: [k for k in ks if k in (r.t or "").lower()] for t, ks in c.keyword_tiers.items()}
    scan = V.keyword_scan("p")["major"]
    assert "contains(" not in df.withColumn("p", V.keyword_places("t")).select(scan)._jdf.queryExecution().analyzed().toString().lower()


def test_a_files_order_is_made_once(spark, tmp_path):
    """the natural key is made of the list of files, not of every record."""
    for n in (9, 10):
        (tmp_path / f"page_{n}.json").write_text("".join('{"inspection_id": "%d"}\n' % i for i in range(50)))
    raw = L.read_pages(spark, str(tmp_path))
    plan = raw._jdf.queryExecution().optimizedPlan().toString()
    own = [x for x in plan.splitlines() if "regexp_extract_all" in x]
    assert own and all("binaryFile" not in x for x in own)
    assert plan.index("Join LeftOuter") < plan.index("regexp_extract_all")
    assert [r.landing.file[-12:] for r in raw.orderBy("landing").collect()][::50] == [
        r.landing.file[-12:] for r in raw.where("inspection_id = '0'").orderBy("landing").collect()]


def test_history_buckets_follow_the_partitions(spark):
    """more shuffle partitions, more buckets; the rows are the same."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    rows = {}
    try:
        for n in ("8", "20"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            with executed_plans(spark) as plans:
                rows[n] = sorted(map(tuple, registry.queries()["bucketed_history"](spark, SF_SMALL).collect()), key=repr)
            assert any(f"REPARTITION_BY_NUM" in p and f"{n})" in p or f", {n}), REPARTITION_BY_NUM" in p for p in plans), n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert rows["8"] == rows["20"]
