"""Concatenate-and-cut packing of tokenised documents into fixed windows.

Pass 1 tokenises every document once and stores its ids with the partition
that made them and the number of ids before it in that partition. The
partitions' totals, one number each, are summed into prefix offsets. Pass 2
adds its partition's offset to each document and cuts at the multiples of the
window: a document that crosses a boundary leaves one record on either side.
Only the partition totals (as many as there were tasks) reach the driver;
nothing is shuffled, and the stored ids make the offsets and the pieces agree
whatever task is run again.
"""

from __future__ import annotations

import json
import os
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .columns import sliced

CACHE_PIECES = 500_000    # pieces whose ids a worker keeps; beyond it the older half goes
GROUP = 64                # documents whose unknown pieces are tokenised together

# Byte classes for parting letters from punctuation: ASCII letters, and the
# second bytes of the Latin-1 letters (first byte C3); ASCII punctuation but
# the apostrophe, which also begins contractions.
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_LATIN = np.zeros(256, bool)
_LATIN[[c - 0x40 for c in range(0xC0, 0x100) if chr(c).isalpha()]] = True
_MARK[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True

_encoders: dict[str, Encoder] = {}


def _parted(text: bytes) -> bytes:
    """``text`` with a space between a letter and the punctuation after it.

    Only where that is sure to part pre-tokens and to leave normalisation as it
    was: an ASCII or Latin-1 letter before ASCII punctuation, in a text without
    anything like a special token. ASCII letters are lower-cased unless the
    text may hold combining marks, which could compose with the one case only.
    """
    if b"<|" in text:
        return text
    raw = np.frombuffer(text, np.uint8)
    mark = np.flatnonzero(_MARK[raw])
    mark = mark[mark > 0]
    before = raw[mark - 1]
    letter = _LETTER[before]
    latin = _LATIN[before] & (mark > 1)
    letter[latin] = raw[mark[latin] - 2] == 0xC3
    if letter.any():
        raw = np.insert(raw, mark[letter], 0x20)
    return raw.tobytes().lower() if raw.max(initial=0) <= 0xC3 else raw.tobytes()


class Encoder:
    """Ids of a text by a ``tokenizers`` file whose pre-tokenizer drops white
    space, as packed little-endian integers of ``dtype``.

    No token crosses white space, so the ids are those of the text's words, and
    a word's ids are kept for its next occurrence. Where the pre-tokenizer also
    lower-cases and parts letters from punctuation, so do we first, which
    leaves fewer different pieces. Unknown pieces of letters alone, or of
    punctuation alone, are one pre-token each; they are tokenised together and
    told apart by the vocabulary's end-of-word mark, if it has one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = own = Tokenizer.from_file(path)
        size = own.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        parts = [x[1] for x in own.pre_tokenizer.pre_tokenize_str("abc,.de!")] if own.pre_tokenizer else []
        lowers = own.normalizer is not None and own.normalizer.normalize_str("AbC") == "abc"
        self.parts = lowers and parts == [(0, 3), (3, 5), (5, 7), (7, 8)]
        self.ends = None
        mark = json.loads(own.to_str())["model"].get("end_of_word_suffix")
        if mark:
            self.ends = np.zeros(size, bool)
            self.ends[[i for t, i in own.get_vocab().items() if t.endswith(mark)]] = True

    def _each(self, texts: list[bytes]) -> list[bytes]:
        got = self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in got]

    def _together(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts that are one pre-token each."""
        if self.ends is None:
            return self._each(texts)
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(texts).decode()], add_special_tokens=False)[0].ids, self.dtype)
        stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(stops) != len(texts) or stops[-1] != len(ids):
            return self._each(texts)                                # some text was not one pre-token after all
        raw, size = ids.tobytes(), self.dtype.itemsize
        return [raw[i * size:j * size] for i, j in zip([0, *stops], stops)]

    def _one_pre_token(self, piece: bytes) -> bool:
        if not self.parts:
            return False
        if piece.isascii():
            return piece.isalpha() or bool(_MARK[np.frombuffer(piece, np.uint8)].all()) and b"<|" not in piece
        return unicodedata.normalize("NFC", piece.decode()).lower().isalpha()

    def _learn(self, missing: set[bytes]) -> None:
        fresh = {True: [], False: []}
        for piece in missing:
            if (ids := self.old.get(piece)) is not None:
                self.new[piece] = ids
            else:
                fresh[self._one_pre_token(piece)].append(piece)
        for one, encode in ((True, self._together), (False, self._each)):
            for i in range(0, len(fresh[one]), 10_000):
                some = fresh[one][i:i + 10_000]
                self.new.update(zip(some, encode(some)))

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of each UTF-8 text."""
        if len(self.new) > CACHE_PIECES // 2:
            self.new, self.old = {}, self.new
        known = self.new.get
        out, again, missing = [], [], set()
        for i, text in enumerate(texts):
            pieces = (_parted(text) if self.parts else text).split()
            ids = list(map(known, pieces))
            if None in ids:
                gaps = [k for k, x in enumerate(ids) if x is None]
                unknown = [pieces[k] for k in gaps]
                missing.update(unknown)
                again.append((i, ids, gaps, unknown))
                out.append(b"")
            else:
                out.append(b"".join(ids))
        if missing:
            self._learn(missing)
        for i, ids, gaps, unknown in again:     # most texts have a new piece: only those are looked up again
            for k, piece in zip(gaps, unknown):
                ids[k] = known(piece)
            out[i] = b"".join(ids)
        return out


def encoder(path: str) -> Encoder:
    """The worker's encoder for a file, loaded once."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine; an absolute path is itself."""
    if os.path.isabs(name):
        return name
    import public_tokenizers
    return public_tokenizers.path(name)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, window: int = 4096,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents laid end to end and cut every ``window`` tokens.

    ``tokenizer`` names a file of ``public_tokenizers`` or is an absolute path;
    its pre-tokenizer must drop white space. A document is its ids and then
    ``end_id``, so null or empty text is one token. One row per piece:
    ``doc_id``, ``start`` (ids of the document before the piece), ``length``,
    ``doc_tokens``, ``sequence_id``, ``offset`` (in the sequence; gapless) and
    ``ids`` (little-endian uint32). Only the last sequence may be short.

    Repeated rows and null ids are packed like any other document; other
    columns are ignored, whatever their names; an empty table gives no rows.
    """
    if window < 1:
        raise ValueError("window must be at least one token")
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()

    def tokenise(batches):
        own, part, before = encoder(tokenizer_path(tokenizer)), TaskContext.get().partitionId(), 0
        for b in sliced(batches):
            texts = [x or b"" for x in b.column("text").cast(pa.binary()).to_pylist()]
            end = np.array([end_id], own.dtype).tobytes()
            ids = [x + end for i in range(0, len(texts), GROUP) for x in own.encode_many(texts[i:i + GROUP])]
            sizes = np.array([len(x) for x in ids], np.int64) // own.dtype.itemsize
            starts = before + np.cumsum(sizes) - sizes
            before += int(sizes.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([part] * len(ids), pa.int32()), pa.array(starts), pa.array(sizes),
                 pa.array(ids, pa.binary())],
                names=["doc_id", "part", "before", "doc_tokens", "ids"])

    tokens = staged(src.mapInArrow(
        tokenise, f"doc_id {kind}, part int, before long, doc_tokens long, ids binary"), "tokens")
    totals = tokens.groupBy("part").agg(F.max(F.col("before") + F.col("doc_tokens")).alias("n")).orderBy("part").collect()
    sums = np.cumsum([0] + [r.n for r in totals]).tolist()
    offset = {r.part: s for r, s in zip(totals, sums)}

    def cut(batches):
        for b in sliced(batches):
            rows, out = [], []
            for i, (part, before, n, raw) in enumerate(zip(*(b.column(c).to_pylist() for c in
                                                           ("part", "before", "doc_tokens", "ids")))):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                at, start = offset[part] + before, 0
                while start < n:
                    size = min(n - start, window - at % window)
                    rows.append(i)
                    out.append((start, size, n, at // window, at % window, ids[start:start + size].tobytes()))
                    start, at = start + size, at + size
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), *(pa.array(c, pa.int64()) for c in cols[:5]),
                 pa.array(cols[5], pa.binary())],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    return tokens.mapInArrow(cut, f"doc_id {kind}, start long, length long, doc_tokens long, "
                                  "sequence_id long, offset long, ids binary")
