"""Serving operators: parameters, defaults and edge cases."""

import pytest
from pyspark.sql import functions as F

from hazardlens.operators import serving as D
from hazardlens.schemas import SCORES


def _scores(spark):
    rows = [
        ("a", "Joe's (Grill)", None, "1 N ST", "60601", "Restaurant", "Risk 1 (High)", 41.0, -87.0,
         5, 2, 1, 2, None, "fail", 62.5, 10.0, 20.0, 56.0, 70.0),
        ("b", "Cafe", "Joe", "2 N ST", "60602", "Bakery", None, None, None,
         2, 0, 0, 2, None, "pass", 0.0, 0.0, 5.0, 44.9, 39.9),
        ("c", "Deli", None, "3 S AVE", None, None, None, 41.1, -87.1,
         1, 1, 0, 0, None, "fail", 100.0, 100.0, 50.0, 50.0, 40.0),
    ]
    return spark.createDataFrame(rows, SCORES)


def test_filters_and_empty_selection(spark):
    s = _scores(spark)
    assert D.apply_filters(s, 40, 70).count() == 2
    assert D.apply_filters(s, 0, 100, [], []).count() == 3
    assert [r.establishment_id for r in D.apply_filters(s, 0, 100, ["Bakery"], ["60602"]).collect()] == ["b"]


def test_search_regex_and_literal(spark):
    s = _scores(spark)
    assert {r.establishment_id for r in D.search(s, "joe").collect()} == {"a", "b"}
    assert D.search(s, "").count() == 3
    assert {r.establishment_id for r in D.search(s, "(grill)", literal=True).collect()} == {"a"}
    assert {r.establishment_id for r in D.search(s, "n st$").collect()} == {"a", "b"}


def test_bands_labels_and_card(spark):
    s = _scores(spark)
    got = {r.establishment_id: (r.band, r.label) for r in D.card_label(s).collect()}
    assert got["a"] == ("high", "Joe's (Grill) — 1 N ST — Score: 70.0")
    assert got["b"][0] == "low" and got["c"][0] == "medium"
    card = {r.establishment_id: r for r in D.detail_card(s).collect()}
    assert card["a"].failure_rate == "62/100"          # half-even, like f"{62.5:.0f}"
    assert card["a"].trend == "Worsening" and card["b"].trend == "Improving" and card["c"].trend == "Stable"
    assert card["a"].last_inspected == "N/A"
    missing = D.detail_card(s.drop("trend_score", "facility_type")).collect()
    assert {r.trend for r in missing} == {"Stable"} and {r.type for r in missing} == {"N/A"}


def test_map_points_and_histogram(spark):
    s = _scores(spark)
    pts = {r.establishment_id: r.size for r in D.map_points(s).collect()}
    assert set(pts) == {"a", "c"} and pts["a"] == 70.0 * 0.6 + 10.0
    hist = {r.bin_start: (r.bin_end, r.establishments) for r in D.score_histogram(s).collect()}
    assert hist == {68.0: (70.0, 1), 38.0: (40.0, 1), 40.0: (42.0, 1)}


@pytest.mark.parametrize("values, width", [
    ([0.0, 100.0], 5), ([100.0], 0.1), ([0.0], 0.1), ([20.0, 76.5], 5), ([40.0, 60.0], 1), ([41.3, 41.9], 0.1), ([0.0, 2500.0], 100)])
def test_histogram_bins_cover_the_range(spark, values, width):
    df = spark.createDataFrame([(v,) for v in [*values, None]], "dynamic_risk_score double")
    rows = D.score_histogram(df).collect()
    assert sum(r.establishments for r in rows) == len(values)
    assert {round(r.bin_end - r.bin_start, 6) for r in rows} == {width}
    last = max(rows, key=lambda r: r.bin_start)
    assert last.bin_start <= max(values) <= last.bin_end + 1e-9
    assert (last.bin_start - min(r.bin_start for r in rows)) / width < 25
    assert D.score_histogram(df.limit(0)).collect() == []


def test_top_n_renames_and_ties(spark):
    s = _scores(spark).withColumn("dynamic_risk_score", F.lit(50.0))
    top = D.top_n(s, 2)
    assert top.columns[:2] == ["Name", "Address"]
    assert [r.Name for r in top.collect()] == ["Joe's (Grill)", "Cafe"]   # ties by key


def test_ttl_cache_refreshes(spark):
    from hazardlens.session import staging_path
    path = staging_path(spark, "ttl")
    _scores(spark).write.parquet(path)
    a = D.load_cached(spark, path, ttl=3600)
    assert D.load_cached(spark, path, ttl=3600) is a and a.is_cached
    _scores(spark).limit(1).write.mode("overwrite").parquet(path)
    b = D.load_cached(spark, path, ttl=0)           # expired: re-read, old copy released
    assert b is not a and b.count() == 1 and not a.is_cached
    D.release_cached(spark, path)
    assert not b.is_cached and D.load_cached(spark, path) is not b
    D.release_cached(spark)


def test_dashboard_over_stored_tables(spark):
    from conftest import AS_OF, SF_SMALL
    from hazardlens.plans.batch import run_transform
    from hazardlens.plans.dashboard import Dashboard, Filters
    from hazardlens.session import staging_path
    from hazardlens.sources.fixtures import raw_inspections
    out = staging_path(spark, "dash")
    run_transform(spark, raw_inspections(spark, SF_SMALL), AS_OF, out_dir=out)
    dash = Dashboard(spark, out)
    p = dash.panels(Filters(lo=20, hi=80))
    k = p["kpis"].first()
    assert k.establishments == dash.scores.filter("dynamic_risk_score BETWEEN 20 AND 80").count()
    assert p["top_n"].count() <= 20 and p["zip_table"].count() <= 15
    hit = dash.lookup("customer#00000")
    assert hit["matches"].count() == 20 and hit["cards"].count() == 20
    assert hit["history"].groupBy("establishment_id").count().agg({"count": "max"}).first()[0] <= 10
    assert dash.facets().filter("facet = 'zip'").count() > 0
