import random

from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm.substring_dedup import remove_repeats
from hazardlens.llm.words import word_hashes, window_hashes, word_spans

from . import brute, data


def same_as_brute(df, rows, window):
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed, r.kept_text) for r in remove_repeats(df, window).collect())
    ws, gone = brute.remove_repeats([r[1] for r in rows], window)
    want = sorted((r[0] or -1, len(w), sum(g), b" ".join(x for x, cut in zip(w, g) if not cut).decode())
                  for r, w, g in zip(rows, ws, gone))
    assert got == want


def test_odd_rows_match_brute_force(spark):
    rows = data.odd_rows()
    same_as_brute(data.frame(spark, rows), rows, 35)


def test_every_window_length_and_alignment(spark):
    """A shared passage at every offset against the blocks, one word long and short of a window."""
    rng = random.Random(1)
    for window in (2, 5, 8):
        passage = [f"p{i}" for i in range(window)]
        rows = [(i, " ".join([f"a{i}.{j}" for j in range(i)] + (passage if i % 3 else passage[1:]) + [f"b{i}", f"c{i}"]), None, None)
                for i in range(2 * window + 2)]
        rows.append((99, data.sentence(rng, 60, words=3), None, None))      # overlapping repeats inside one text
        same_as_brute(data.frame(spark, rows), rows, window)


def test_runs_are_the_removed_words(spark):
    rows = data.odd_rows()
    for r in remove_repeats(data.frame(spark, rows), 35).collect():
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_empty_table(spark):
    assert remove_repeats(data.frame(spark, [(1, "a b", None, None)]).limit(0)).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \t\n\x0b\x0c\r é", max_size=60))
def test_words_and_hashes(text):
    raw = text.encode()
    spans = list(zip(*(x.tolist() for x in word_spans(raw))))
    assert [raw[i:j] for i, j in spans] == raw.split()
    hashes = word_hashes(raw).tolist()
    assert [hashes.index(h) for h in hashes] == [raw.split().index(w) for w in raw.split()]
    grams = [tuple(hashes[i:i + 2]) for i in range(len(hashes) - 1)]
    rolled = window_hashes(word_hashes(raw), 2).tolist()
    assert [rolled.index(r) for r in rolled] == [grams.index(g) for g in grams]
