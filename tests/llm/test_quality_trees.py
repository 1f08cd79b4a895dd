import numpy as np

from hazardlens.llm import quality_trees as Q

from . import data


def walk(trees, row):
    """One row down every tree, node by node."""
    score = trees.start
    inner = trees.feature.shape[1]
    for f, t, v in zip(trees.feature, trees.threshold, trees.value):
        at = 0
        while at < inner:
            at = 2 * at + (2 if row[f[at]] > t[at] else 1)
        score += v[at - inner]
    return 1 / (1 + np.exp(-score))


def test_flattened_traversal_and_fit():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(3000, 5)), 1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] * x[:, 3] > 0.2)).astype(float)
    trees = Q.grow(x[:2000], y[:2000], Q.Settings())
    p = Q.probabilities(trees, x)
    assert np.allclose(p, [walk(trees, r) for r in x])
    assert ((p[2000:] > 0.5) == y[2000:]).mean() > 0.9


def test_histogram_split_is_the_best_threshold():
    """One tree of depth one against every cut tried in turn."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 20, (400, 3)).astype(float)
    y = (x[:, 1] > 12).astype(float)
    y[:25] = 1 - y[:25]
    s = Q.Settings(trees=1, depth=1)
    trees = Q.grow(x, y, s)
    g, h = y.mean() - y, y.mean() * (1 - y.mean())

    def gain(mask):
        if min(mask.sum(), (~mask).sum()) < s.min_rows:
            return 0
        return sum(g[m].sum()**2 / (h * m.sum() + s.l2) for m in (mask, ~mask))

    best = max((gain(x[:, f] <= c), -f, -c) for f in range(3) for c in range(20))
    assert (trees.feature[0, 0], trees.threshold[0, 0]) == (-best[1], -best[2]) == (1, 12)


def test_constant_features_and_one_label():
    trees = Q.grow(np.zeros((50, 2)), np.ones(50), Q.Settings(trees=5))
    assert (Q.probabilities(trees, np.zeros((3, 2))) > 0.9).all()


def test_held_out_accuracy(spark, queries):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries["op6_quality_classifier"](spark, sf).collect()
    apart = [r for r in got if r.held_out and r.doc_id in labels]
    assert len(apart) > 500
    assert np.mean([r.predicted == labels[r.doc_id] for r in apart]) >= 0.98
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = data.odd_rows()
    df = data.frame(spark, rows).drop("score")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100, 140)] + [(None, 1), (8, None), (4, 1), (4, 0)], "x long, y int")
    trees = Q.fit(df, labels, Q.Settings(trees=5, min_rows=2))
    got = Q.score(df, trees)
    assert got.columns == [*df.columns, "score"] and got.count() == len(rows)
    empty = {r.score for r in got.collect() if not (r.text or "").strip()}
    assert len(empty) == 1
    assert Q.score(df.limit(0), trees).collect() == []
    none = Q.fit(df, labels.limit(0))
    assert {r.score for r in Q.score(df, none).collect()} == {0.5}


def test_fitted_rows_are_bounded(spark, monkeypatch):
    """One labelled id in thousands of rows, equal ones and different ones, brings no more rows than ids may."""
    seen = []
    monkeypatch.setattr(Q, "grow", lambda x, y, settings: seen.append(len(x)))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "id int, y int")
    equal = spark.range(3_000).selectExpr("1 AS doc_id", "'the same words' AS text")
    Q.fit(equal, labels, Q.Settings(sample_rows=10))
    Q.fit(equal.unionAll(spark.range(3_000).selectExpr("2 AS doc_id", "concat('words ', id) AS text")), labels, Q.Settings(sample_rows=10))
    Q.fit(spark.range(1, 3).selectExpr("id AS doc_id", "'one text' AS text"), labels, Q.Settings(sample_rows=10))
    assert seen == [1, 10, 2]


def test_features_are_finite():
    for text in ("", " \n", "a", "x" * 100_000, "|" * 3 + "\n\n", "é\n" * 500, "\x00 a"):
        row = Q.features(text.encode())
        assert len(row) == len(Q.FEATURES) and np.isfinite(row).all()
