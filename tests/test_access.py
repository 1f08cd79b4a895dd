"""Access paths: layouts that skip rows, postings for the search, panels from one rollup."""

import random

import pytest
from conftest import AS_OF, SF_SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardlens.operators import rollup as RU
from hazardlens.operators import search_index as SI
from hazardlens.operators import serving as D
from hazardlens.schemas import SCORES
from hazardlens.session import staging_path
from hazardlens.sinks import layout as LY
from hazardlens.sinks import snapshots as SN

WORDS = ["Joe's", "GRILL (old)", "café", "Deli+Bar", "a.b", "N ST", "😀 house", "O'Hare", "Ååå", "x"]


@pytest.fixture(scope="module")
def scores(spark):
    pick = random.Random(5)
    rows = []
    for i in range(4000):
        zip_ = None if i % 97 == 0 else "60601" if i % 3 == 0 else f"{60600 + pick.randrange(60)}"
        kind = pick.choice(["Restaurant", "Bakery", None, f"kind {pick.randrange(40)}"])
        score = None if i % 53 == 0 else pick.randrange(1001) / 10
        name, alias, address = (pick.choice([None, "", " ".join(pick.choices(WORDS, k=3)) + f" {i}"]) for _ in range(3))
        rows.append((f"e{i:05}", name, alias, address, zip_, kind, None, None, None, pick.randrange(9), pick.randrange(4),
                     0, 0, None, None, 0.0, 0.0, 0.0, 50.0, score))
    path = staging_path(spark, "access")
    spark.createDataFrame(rows, SCORES).coalesce(2).write.parquet(path)
    return spark.read.parquet(path)


def rows_read(df):
    """Result rows, and how many rows the one scan handed on after skipping."""
    found = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return found, leaf.metrics().get("numOutputRows").get().value()


@pytest.fixture(scope="module")
def curved(spark):
    """80,000 rows in 64 files: large enough for row groups to tell apart."""
    n = 80_000
    key = F.md5(F.col("id").cast("string"))
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "60601").otherwise((60600 + F.xxhash64("id", F.lit(1)) % 50 + 50).cast("string")).alias("zip"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1001)) / 10).alias("dynamic_risk_score"), key.alias("establishment_id"))
    path = staging_path(spark, "curved")
    LY.zordered(df, path, n_files=64, bloom={"establishment_id": 2_000})
    return df, spark.read.parquet(path)


@pytest.mark.parametrize("where, share", [
    ("zip = '60640'", 0.25), ("zip = '60601'", 0.6), ("dynamic_risk_score BETWEEN 97 AND 100", 0.25),
    ("zip = '60601' AND dynamic_risk_score >= 97", 0.1), ("establishment_id = md5('4711')", 0.1)])
def test_each_filter_reads_a_small_share(curved, where, share):
    df, stored = curved
    found, read = rows_read(stored.where(where))
    assert sorted(found) == sorted(df.where(where).select(stored.columns).collect()) and found
    assert read <= share * df.count(), read


def test_curved_rows_are_all_there(spark, scores):
    path = staging_path(spark, "curved-odd")
    LY.zordered(scores, path, n_files=4)
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, scores.collect()))
    for empty in (scores.limit(0), scores.withColumn("zip", F.lit(None).cast("string"))):
        path = staging_path(spark, "curved-empty")
        LY.zordered(empty, path)
        assert spark.read.schema(scores.schema).parquet(path).count() == empty.count()
    with pytest.raises(ValueError):
        LY.zordered(scores.withColumn("_z", F.lit(1)), path)


def test_curve_interleaves_bits(spark):
    a, b = 0b101, 0b011
    z = LY.curve([F.lit(a).cast("long"), F.lit(b).cast("long")], bits=3)
    assert spark.range(1).select(z).first()[0] == 0b100111


def test_dated_layout_skips_periods_and_other_establishments(spark):
    df = spark.range(60_000).select(
        F.col("id").cast("string").alias("inspection_id"), F.md5((F.col("id") % 20_000).cast("string")).alias("establishment_id"),
        F.expr("timestamp_ntz '2000-01-01' + make_dt_interval(cast(pmod(xxhash64(id), 3000) as int))").alias("inspection_date"))
    path = staging_path(spark, "dated")
    LY.dated(df, path, n_files=32, bloom={"establishment_id": 2_000})
    stored = spark.read.parquet(path)
    since, one = "inspection_date BETWEEN '2008-01-01 00:00:00' AND '2009-01-01 12:00:00'", "establishment_id = md5('77')"
    for some, where, share in ((LY.period(stored, "2008-01-01", "2009-01-01 12:00:00"), since, 0.12),
                               (stored.where(one).drop(LY.DAY), one, 0.3)):
        found, read = rows_read(some)
        assert sorted(found) == sorted(df.where(where).collect()) and found and read <= share * 60_000, (where, read)
    with pytest.raises(ValueError):
        LY.dated(stored, path)


TERMS = ["joe", "joe's g", "(old)", "grill \\(old\\)", "caf[eé] ", "deli+bar", "deli\\+bar", "a.b n", "^x", "st \\d+$", "house|deli",
         "(?x) j o e", "no such", "😀 house", "o'h?are", "o'ha{1,2}re", "ååå", "ab", "", "n st (x|a\\.b)", "\\bgrill", "n.st", "x{2}yz*"]


@pytest.mark.parametrize("literal", [False, True])
def test_postings_find_what_the_scan_finds(spark, scores, literal, monkeypatch):
    path = staging_path(spark, "postings")
    SI.store_postings(scores, path, n_files=2)
    stored = spark.read.parquet(path)
    monkeypatch.setattr(SI, "MAX_SHARE", 1.0)
    hits = 0
    for term in TERMS:
        want = {r[0] for r in D.search(scores, term, literal).select(D.KEY).collect()}
        assert {r[0] for r in SI.search(scores, stored, term, literal).select(D.KEY).collect()} == want, term
        hits += bool(want)
    assert hits >= 8


def test_postings_of_brute_force(scores):
    want = {(t[i:i + 3], r.establishment_id) for r in scores.collect()
            for t in map(str.lower, filter(None, (r.dba_name, r.aka_name, r.address))) for i in range(len(t) - 2)}
    assert sorted(map(tuple, SI.postings(scores).collect())) == sorted(want)


def test_a_rare_term_reads_few_rows(spark, scores, monkeypatch):
    path = staging_path(spark, "postings-few")
    SI.store_postings(scores, path, n_files=16)
    stored = spark.read.parquet(path)
    assert SI.required_text("customer#1.*x") == ["customer#1", "x"] and SI.term_grams("a|customer") == []
    called = []
    monkeypatch.setattr(D, "search", lambda df, *a: called.append(df) or df)
    SI.search(scores, stored, "st 3999")
    assert called.pop() is not scores                     # through the postings
    SI.search(scores, stored, "x")
    assert called.pop() is scores                         # no sequence: the scan
    _, read = rows_read(stored.where(F.col("gram").isin("999")))
    assert read <= 0.2 * stored.count()


@settings(max_examples=300, deadline=None, derandomize=True)
@given(st.text("ab.c*+?{}1,()[]\\|^$dz", max_size=9), st.text("abc1dz", max_size=12))
def test_required_text_is_in_every_match(term, text):
    import re
    try:
        if not re.search(term, text):
            return
    except re.error:
        return
    assert all(piece in text for piece in SI.required_text(term))


FILTERS = [{}, {"lo": 20, "hi": 80}, {"zips": ["60601", "60610"]}, {"facility_types": ["Bakery"], "hi": 55.5}, {"zips": ["none"]}]


@pytest.mark.parametrize("chosen", FILTERS)
def test_panels_from_the_rollup_equal_those_from_the_scores(scores, chosen):
    rows = D.apply_filters(scores, **chosen)
    parts = [RU.score_rollup(scores.where(F.pmod(F.xxhash64(D.KEY), F.lit(3)) == i)) for i in range(3)]
    for rollup in (RU.score_rollup(scores), RU.merge(*parts)):
        sums = RU.panel_sums(D.apply_filters(rollup, **chosen)).cache()
        assert RU.kpis(sums).collect() == D.kpis(rows).collect()
        assert sorted(RU.score_histogram(sums).collect()) == sorted(D.score_histogram(rows).collect())
        assert RU.risk_by_facility(sums).collect() == D.risk_by_facility(rows).collect()
        assert sorted(RU.risk_by_zip(sums).collect()) == sorted(D.risk_by_zip(rows).collect())
        assert RU.zip_table(sums).collect() == D.zip_table(rows).collect()
        assert RU.zip_chart(sums).collect() == D.zip_chart(rows).collect()
        sums.unpersist()


def test_unfiltered_rollup_keeps_null_scores(scores):
    sums = RU.panel_sums(RU.score_rollup(scores))
    assert RU.kpis(sums).collect() == D.kpis(scores).collect()
    assert RU.zip_chart(sums).collect() == D.zip_chart(scores).collect()
    assert RU.kpis(RU.panel_sums(RU.score_rollup(scores.limit(0)))).collect() == D.kpis(scores.limit(0)).collect()


def test_dashboard_uses_the_snapshots_postings_and_one_rollup(spark, monkeypatch):
    from hazardlens.plans.batch import run_transform
    from hazardlens.plans.dashboard import Dashboard, Filters
    from hazardlens.sources.fixtures import raw_inspections
    out = run_transform(spark, raw_inspections(spark, SF_SMALL), AS_OF, out_dir=staging_path(spark, "to-publish"))
    base = staging_path(spark, "published")
    SN.publish(out.inspections, out.scores, base, search_index=True)
    dash = Dashboard(spark, base)
    used = []
    through = SI.search_top
    monkeypatch.setattr(SI, "search_top", lambda *a: used.append(1) or through(*a))
    want = [r[0] for r in D.search_top(dash.scores, "customer#00000011").select(D.KEY).collect()]
    assert [r[0] for r in dash.lookup("customer#00000011")["matches"].select(D.KEY).collect()] == want and want and used
    first = dash.panels(Filters(lo=20, hi=80))
    rollup = dash.rollup
    second = dash.panels()
    assert dash.rollup is rollup and rollup.is_cached
    for panels, rows in ((first, D.apply_filters(dash.scores, 20, 80)), (second, D.apply_filters(dash.scores))):
        assert panels["kpis"].collect() == D.kpis(rows).collect()
        assert panels["zip_chart"].collect() == D.zip_chart(rows).collect()
