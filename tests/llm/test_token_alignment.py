import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import token_alignment as T
from hazardlens.llm.packing import tokenizer_path

from . import brute, data

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tools():
    own = T.aligner(tokenizer_path(A), tokenizer_path(B))
    assert own.parts and own.fast
    return own


def expected(texts, tools):
    return brute.link_counts(brute.alignment([t or "" for t in texts], tools.a, tools.b))


def digest(spelt):
    return hashlib.sha256(spelt.encode()).hexdigest() if spelt else ""


ODD = ["a", " ", "\n", "  two  spaces ", "tab\tand\nline\n\nbreaks\n \n", "trail ", "\n lead", "it's we're 'tis", "1234567 89",
       "<|endoftext|> <s> </s> <unk> <0x0A>", "under▁score", "nbsp x　y z\x85w \x1c q", "café naïve été ça",
       "é combining", "你好 世界", "\U0001f600\U0001f680 x", "a" * 3000, "ab" * 2000, "x" + " " * 300 + "y", "\x00 nul",
       "ﬁ ligature Ω", "z\n\ny", "z \ny", "z\n y", "é é\né"]


def test_links_match_brute_force(spark, tools):
    rows = data.odd_rows()
    rows = [(i, (t or "")[:3000] if t else t, la, s) for i, t, la, s in rows] + [(900 + i, t, "en", "q") for i, t in enumerate(ODD)]
    df = data.frame(spark, rows)
    got = sorted(((r.doc_id or -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                  for r in T.link_counts(df.repartition(5)).collect()))
    want = sorted((r[0] or -1, *e[:-1], digest(e[-1])) for r, e in zip(rows, expected([r[1] for r in rows], tools)))
    assert got == want
    assert sum(r[1] == 0 for r in got) >= 4


def test_groups_are_the_cuts(spark, tools):
    rows = [(i, t, None, None) for i, t in enumerate(ODD)]
    got = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in T.align(data.frame(spark, rows)).collect()}
    for (i, t, _, _), want in zip(rows, brute.alignment(ODD, tools.a, tools.b)):
        assert got[i] == [(list(x), list(y)) for x, y in want], t


def test_parts_of_the_corpus_are_summed(spark, tools, monkeypatch):
    """Counts of many scan tasks and small chunks, summed over parts first."""
    monkeypatch.setattr(T, "TASKS_OF_PART", 2)
    monkeypatch.setattr(T, "CHUNK_BYTES", 400)
    rng = random.Random(2)
    rows = [(i, data.sentence(rng, rng.randrange(0, 60), words=90), None, None) for i in range(60)]
    got = sorted((r.doc_id, r.n_best, r.count_sum) for r in T.link_counts(data.frame(spark, rows).repartition(7)).collect())
    assert got == sorted((r[0], e[4], e[5]) for r, e in zip(rows, expected([r[1] for r in rows], tools)))


def test_empty_table(spark):
    df = data.frame(spark, [(1, "a", None, None)]).limit(0)
    assert T.link_counts(df).collect() == [] and T.align(df).collect() == []


@settings(max_examples=400, deadline=None, derandomize=True)
@given(st.text(alphabet=st.sampled_from("ab'stX1 \n\t.,é ▁你́\U0001f600\x85　<|>_"), max_size=40))
def test_pieces_give_the_tokenizers_ids(text):
    own = T.aligner(tokenizer_path(A), tokenizer_path(B))
    a, b = (np.frombuffer(x, "<u4").tolist() for x in own.encode_many([text.encode()])[0])
    if a:
        assert a == own.a.encode(" " + text, add_special_tokens=False).ids and b == own.b.encode(text)
    else:
        assert brute.alignment([text], own.a, own.b) == [[]]


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.integers(0, 10**6)), min_size=1, max_size=4))
def test_cuts_by_halving(texts):
    """Random token lengths over several texts, some empty, against a plain set of shared ends."""
    a_ends, b_ends, a_cuts, b_cuts, base, want = [], [], [0], [0], 0, []
    for lengths, seed in texts:
        total = sum(lengths)
        inner = sorted(random.Random(seed).sample(range(1, total), min(total - 1, seed % 7))) if total > 1 else []
        a = [sum(lengths[:i + 1]) for i in range(len(lengths))]
        b = [*inner, total]
        cut = [0, *sorted(set(a) & set(b))]
        want += [(a_cuts[-1] + sum(x <= c for x in a), b_cuts[-1] + sum(x <= c for x in b)) for c in cut[:-1]]
        a_ends += [base + x for x in a]
        b_ends += [base + x for x in b]
        a_cuts += [len(a_ends)] * 2             # and an empty text behind it
        b_cuts += [len(b_ends)] * 2
        base += total
    a_at, b_at = T.groups(*(np.array(x, np.int64) for x in (a_ends, b_ends, a_cuts, b_cuts)))
    assert list(zip(a_at[:-1].tolist(), b_at[:-1].tolist())) == want


def test_wide_groups_count_equal_links_once(monkeypatch):
    a, b = np.array([5, 5, 6, 7]), np.array([1, 2, 1, 3])
    at = np.array([0, 3, 4])
    plain = T.link_pairs(a, b, at, at)
    monkeypatch.setattr(T, "WIDE", 4)
    wide = T.link_pairs(a, b, at, at)
    count = lambda out: sorted((k, sum(t for *p, t in zip(*(x.tolist() for x in out)) if tuple(p) == k))
                               for k in {tuple(p) for *p, _ in zip(*(x.tolist() for x in out))})
    assert count(plain) == count(wide) and len(wide[0]) < len(plain[0])
