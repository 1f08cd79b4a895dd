import functools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hazardlens.llm import packing as P

from . import data


@functools.cache
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.tokenizer_path("word_bpe_49k.json"))


def reference_ids(texts):
    tok = tokenizer()
    return [e.ids + [2] for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.mark.parametrize("window", [7, 512, 4096])
def test_round_trip(spark, window):
    rows = data.odd_rows()
    rows += [(900, "it's <|endoftext|> it's a<|startoftext|>b é́ Å don't line x 12345 ǅ İ", None, None)]
    df = data.frame(spark, rows).repartition(7)
    pieces = sorted(P.pack(df, window=window).collect(), key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in pieces:                                      # gapless, full windows, in order
        assert (r.sequence_id, r.offset) == divmod(at, window) and 0 < r.length <= window - r.offset
        at += r.length
    docs, ids = [], []
    for r in pieces:
        if r.start == 0:
            docs.append((r.doc_id, r.doc_tokens))
            ids.append([])
        assert len(ids[-1]) == r.start and docs[-1] == (r.doc_id, r.doc_tokens)
        ids[-1] += np.frombuffer(r.ids, "<u4").tolist()
    want = reference_ids([r[1] for r in rows])
    assert sorted((d[0] or -1, x) for d, x in zip(docs, ids)) == sorted((r[0] or -1, x) for r, x in zip(rows, want))
    assert all(d[1] == len(x) for d, x in zip(docs, ids))


def test_word_cache_is_bounded_and_exact(monkeypatch):
    monkeypatch.setattr(P, "CACHE_PIECES", 20)
    own = P.Encoder(P.tokenizer_path("word_bpe_49k.json"))
    texts = [" ".join(f"word{i + j}" for j in range(15)) for i in range(0, 300, 3)]
    for text, want in zip(texts, reference_ids(texts)):
        got, = own.encode_many([text.encode()])
        assert np.frombuffer(got, own.dtype).tolist() == want[:-1]
        assert len(own.new) <= 30 and len(own.old) <= 30


ODD = ["word, Word. WORD!!", "Σίσυφος ΣΊΣΥΦΟΣ, ΣΑΣ.", "İstanbul İ, J̌ǰ J̌ á, Á!", "it's don't 'twas 'S'T", "a<|endoftext|>,",
       "<|startoftext|>! <| |>", "…, word…, ,,, ... $$$ *** 12,5 3.14. a1, 1a.", "ǅ ﬀ ß, straße. ẞ!", "日本語, 日本語。 ไทย.", "é‍, x y, z w.",
       "naïve, ﬃ! ªº, ²³ Ⅷ, ⓐ.", "", " ", "ﷺ,", "𝐀, 😀!", "क्षि, नि.", "a\x00b, \x7f."]


def test_odd_words_one_by_one_and_together():
    own = P.Encoder(P.tokenizer_path("word_bpe_49k.json"))
    want = [x[:-1] for x in reference_ids(ODD)]
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode_many([t.encode() for t in ODD])]
    assert got == want
    assert own.ends is not None and own.parts


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="aAbZ\u0958éÉΣσςİıJ̌́ß,.!'<|>0９ 	…日", max_size=12), min_size=1, max_size=6))
def test_any_words(texts):
    own = P.encoder(P.tokenizer_path("word_bpe_49k.json"))
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode_many([t.encode() for t in texts])]
    assert got == [x[:-1] for x in reference_ids(texts)]


def test_a_vocabulary_without_end_of_word_marks():
    own = P.Encoder(P.tokenizer_path("word_bpe_49k.json"))
    own.ends, own.parts = None, False
    got = [np.frombuffer(x, own.dtype).tolist() for x in own.encode_many([t.encode() for t in ODD])]
    assert got == [x[:-1] for x in reference_ids(ODD)]


def test_empty_table(spark):
    assert P.pack(data.frame(spark, [(1, "a", None, None)]).limit(0)).collect() == []


def test_only_unknown_pieces_are_looked_up_again():
    """op7_packing: a text with one new piece among many known ones costs one lookup more, not as many again."""
    class Counted(dict):
        asked = 0

        def get(self, key):
            self.asked += 1
            return super().get(key)

    own = P.Encoder(P.tokenizer_path("word_bpe_49k.json"))
    text = " ".join(f"word{i % 7}" for i in range(200))
    own.encode_many([text.encode()])
    own.new = Counted(own.new)
    got, = own.encode_many([f"{text} zzyzx {text}".encode()])
    assert own.new.asked <= 410
    assert np.frombuffer(got, own.dtype).tolist() == own.tokenizer.encode(f"{text} zzyzx {text}", add_special_tokens=False).ids
