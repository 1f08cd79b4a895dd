import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.llm import vector_search as V

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("shard", T.StringType()), T.StructField("v", T.IntegerType())])
LONG = 2**63 - 1


def cut(x):
    return max(-LONG, min(LONG, x))


def plain(rows, k, every):
    ok = {(i, tuple(cut(math.floor(256 * x)) for x in v)) for i, v, *_ in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i in sorted({i for i, _ in ok if i % every == 0}):
        found = sorted((-cut(sum(a * b for a, b in zip(q, c))), j) for own, q in ok if own == i for j, c in ok
                       if j != i and len(c) == len(q))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(found[:k])]
    return sorted(out)


def same(spark, rows, k=5, every=5, **options):
    df = spark.createDataFrame([(*r, "x", None) for r in rows], SCHEMA)
    got = V.top_k(df, F.col("id") % every == 0, k, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, k, every)


@pytest.mark.parametrize("shards", [1, 3, None])
def test_matches_brute_force(spark, shards):
    rng = random.Random(shards)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]             # one vector in very many rows: ties by id
    rows += [(2000 + i, [rng.choice([-1.0, 0.0, 1.0]) for _ in range(6)]) for i in range(200)]
    same(spark, rows, shards=shards)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None), (5, []), (10, [1.0, None]), (15, [nan, 1.0]), (20, [inf, 1.0]), (None, [1.0, 2.0]), (25, [1.0, 2.0]),
            (25, [1.0, 2.0]), (25, [3.0, 4.0]), (1, [1.0, 2.0]), (2, [-0.001, 0.0]), (30, [1.0]), (35, [1.0, 1.0, 1.0]),
            (40, [1e18, 1.0]), (3, [1e18, -2.0]), (45, [-1e300, 1e300]), (4, [1e16 + 1, 3.0])]
    same(spark, rows)
    same(spark, rows, k=1)
    same(spark, [(0, [1.0, 1.0])])
    same(spark, [(1, [1.0, 1.0])])
    df = spark.createDataFrame([], SCHEMA)
    assert V.top_k(df, F.col("id") % 5 == 0).collect() == []
    with pytest.raises(ValueError):
        V.top_k(df, F.lit(True), 0)


def test_tree_is_tight_and_prunes():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 8)) * 2000
    v = np.floor(centres[rng.integers(0, 20, 5000)] + rng.normal(size=(5000, 8)) * 20).astype("<i8")
    tree = V.Tree(np.arange(5000), v)
    for k in range(len(tree.first)):
        own = tree.vectors[tree.first[k]:tree.last[k]]
        assert (tree.lo[k] == own.min(0)).all() and (tree.hi[k] == own.max(0)).all()
    loaded = V.Tree.load(tree.dump(), 8)
    opened = []
    loaded.vectors = type("Seen", (), {"__getitem__": lambda s, x, a=loaded.vectors: opened.append(x) or a[x]})()
    scores = v @ v[7]
    want = sorted(((-s, i) for i, s in enumerate(scores.tolist()) if i != 7))[:5]
    assert [(-s, i) for s, i in loaded.search(7, v[7], 5, None)] == want
    assert len(opened) < (tree.left < 0).sum() / 3
    floor = -want[0][0] + 1
    assert loaded.search(7, v[7], 5, floor) == []         # a propagated floor above all: nothing is found
