import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import ranked_search as R

from . import brute, data


def same_as_brute(df, items_df, rows, items, k):
    got = {}
    for r in R.ranked(df, items_df, k).collect():
        got.setdefault((r.item, r.score), []).append((r.rank, r.doc_id))
    want = {}
    for (item, _), best in brute.ranked([r[:2] for r in rows], items, k).items():
        for rank, (doc, score) in enumerate(best, 1):
            want.setdefault((item, score), []).append((rank, doc))
    key = lambda x: (x[0], x[1] is None, x[1] or 0)
    assert {k: sorted(v, key=key) for k, v in got.items()} == {k: sorted(v, key=key) for k, v in want.items()}
    return got


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS doc_id", "1 AS rank", "2 AS score")


def queries_of(rows, seed=4):
    rng = random.Random(seed)
    items = [(i, data.sentence(rng, rng.randrange(1, 40))) for i in range(12)]
    items += [(20, rows[0][1]), (21, None), (22, ""), (23, "...!"), (24, "nothing_of_this zzz"), (25, "The THE the w1 w2 w2"),
              (26, "nbsp is no separator \U0001f600"), (None, "w5 w6 w7")]
    return items


@pytest.mark.parametrize("k", [1, 10])
def test_odd_rows_match_brute_force(spark, k):
    rows = data.odd_rows()
    items = queries_of(rows)
    got = same_as_brute(data.frame(spark, rows).repartition(3), items_frame(spark, items + items[:3]), rows, items, k)
    assert len(got) > 12


def test_small_shards_and_blocks(spark, monkeypatch):
    """Many shards, the kth score handed on between them, and several blocks of queries."""
    monkeypatch.setattr(R, "SHARD_POSTINGS", 60)
    monkeypatch.setattr(R, "BLOCK_BYTES", 300)
    rng = random.Random(9)
    rows = [(i, data.sentence(rng, rng.randrange(0, 30), words=50), None, None) for i in range(200)]
    items = queries_of(rows)
    same_as_brute(data.frame(spark, rows).repartition(2), items_frame(spark, items), rows, items, 4)


def test_ties_of_very_many_copies(spark):
    rows = [(5000 - i, "one passage that is copied", None, None) for i in range(3000)] + [(9000 + i, f"one other text {i}", None, None) for i in range(4000)]
    got = same_as_brute(data.frame(spark, rows), items_frame(spark, [(1, "copied passage")]), rows, [(1, "copied passage")], 10)
    assert sorted(x for v in got.values() for x in v) == [(i + 1, 2001 + i) for i in range(10)]


def test_empty_tables(spark):
    docs, items = data.frame(spark, [(1, "a b", None, None)]), items_frame(spark, [(1, "a")])
    assert R.ranked(docs.limit(0), items).collect() == []
    assert R.ranked(docs, items.limit(0)).collect() == []
    assert R.ranked(docs, items_frame(spark, [(1, "-")])).collect() == []


def test_terms():
    text = "Ab-cÉé X9_\x7fİ[z]\x00{y}"
    assert [w.decode() for w in R.terms(text.encode())] == ["ab", "cÉé", "x9", "İ", "z", "y"]


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=40))
def test_range_maxima(values):
    keys = np.array(values)
    table = R.range_maxima(keys, len(keys))
    for i in range(len(keys)):
        for j in range(i + 1, len(keys) + 1):
            log = (j - i).bit_length() - 1
            assert max(table[log, i], table[log, j - (1 << log)]) == max(values[i:j])


def test_bounds_spare_most_documents():
    """A query of a rare term scores a few documents of a shard, not all."""
    rng = np.random.Generator(np.random.PCG64(1))
    docs = np.repeat(np.arange(4000), 2)
    of_terms = np.tile([0, 1], 4000)
    impacts = rng.integers(1, 1000, 8000)
    shard = R.Shard(np.arange(4000), docs, of_terms, impacts)
    calls = []
    whole, shard._bounds = shard._bounds, lambda r, t, lo, hi: calls.append(len(lo)) or whole(r, t, lo, hi)
    empty = np.zeros(0, np.int64)
    scores, ids = shard.search(np.array([0, 1]), np.array([1, 3]), 10, (empty, empty))
    plain = np.bincount(docs, impacts * np.where(of_terms, 3, 1), 4000).astype(int)
    order = np.lexsort((np.arange(4000), -plain))[:10]
    assert scores.tolist() == plain[order].tolist() and ids.tolist() == order.tolist()
    assert sum(calls) < 2000
