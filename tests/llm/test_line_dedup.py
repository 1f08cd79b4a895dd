import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import chunks, line_dedup as L

from . import brute, data


def same_as_brute(df, rows, min_chars, min_docs):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_lines, r.n_dropped, r.kept_text)
                 for r in L.drop_repeated_lines(df, min_chars, min_docs).collect())
    want = brute.drop_repeated_lines([r[:2] for r in rows], min_chars, min_docs)
    assert got == sorted((r[0] is None, r[0] or 0, *w) for r, w in zip(rows, want))
    return got


def lined_rows(seed=5):
    rng = random.Random(seed)
    common = [data.sentence(rng, 15) for _ in range(6)]
    rows = []
    for i in range(120):
        lines = [data.sentence(rng, rng.randrange(0, 25)) for _ in range(rng.randrange(0, 6))]
        lines += [rng.choice(("", " \t", "\r\x0b")) + (c.upper() if rng.random() < 0.5 else c) + rng.choice(("", "\r", " "))
                  for c in rng.sample(common, rng.randrange(0, 4))]
        rng.shuffle(lines)
        rows.append((rng.choice((i, i, i, 7, None)), "\n".join(lines), None, None))
    return rows


def test_odd_rows_match_brute_force(spark):
    rows = data.odd_rows() + lined_rows()
    got = same_as_brute(data.frame(spark, rows).repartition(4), rows, 40, 5)
    assert sum(r[3] for r in got) > 100


def test_small_chunks_and_thresholds(spark, monkeypatch):
    monkeypatch.setattr(chunks, "CHUNK_BYTES", 300)
    rows = lined_rows(6)
    for min_chars, min_docs in ((1, 1), (10, 2), (40, 40)):
        same_as_brute(data.frame(spark, rows).repartition(6), rows, min_chars, min_docs)


def test_code_points_decide_not_bytes(spark):
    lines = ["é" * 39, "é" * 40, "\U0001f600" * 12, "x" * 39 + " ", " " + "y" * 40, "É" * 40]
    rows = [(i, "\n".join(lines), None, None) for i in range(5)]
    got = same_as_brute(data.frame(spark, rows), rows, 40, 5)
    assert [r[3] for r in got] == [3, 3, 3, 3, 0]


def test_copies_of_one_document_lose_all_but_the_largest(spark):
    rows = [(i % 300, "A line that very many documents hold, word for word.\nown", None, None) for i in range(900)]
    got = same_as_brute(data.frame(spark, rows), rows, 40, 5)
    assert sum(r[3] for r in got) == 897


def test_index_rows_hold_counts_and_keepers(spark):
    rows = lined_rows(7)
    held = 0
    for r in L.line_index(data.frame(spark, rows), 10, 3, shards=4).collect():
        counts = np.frombuffer(r.counts, "<u4")
        assert r.n == len(counts) == len(r.fingerprints) // 4 and len(r.keepers) // 8 == (counts >= 3).sum()
        assert L.PerfectHash.from_bytes(r.levels).n == r.n
        held += int(counts.sum())
    keys = [{x.strip(" \t\n\x0b\x0c\r").lower() for x in (t or "").split("\n")} for _, t, _, _ in rows]
    assert held == sum(len([k for k in own if len(k) >= 10]) for own in keys)


def test_empty_table_and_ids(spark):
    df = data.frame(spark, [(1, "a", None, None)])
    assert L.drop_repeated_lines(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        L.drop_repeated_lines(df, id_col="text")


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.integers(0, 4000), st.integers(0, 2**32))
def test_perfect_hash_is_minimal(n, seed):
    """Numbers 0..n-1, one each, also among keys that share a place; others are told by their fingerprint."""
    rng = np.random.Generator(np.random.PCG64(seed))
    places = rng.integers(0, max(1, n // 2) + 1, n, dtype=np.uint64)
    prints = np.arange(n, dtype=np.uint32)
    own = L.PerfectHash.from_bytes(L.PerfectHash.build(places, prints).to_bytes())
    at = own.lookup(places, prints)
    assert sorted(at.tolist()) == list(range(n)) == list(range(own.n))
    table = np.zeros(n, np.uint32)
    table[at] = prints
    other = own.lookup(places, prints + np.uint32(n))
    assert not (table[other[other >= 0]] == (prints + np.uint32(n))[other >= 0]).any()
