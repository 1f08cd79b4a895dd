"""Cross-tokenizer alignment: groups between shared token ends, and which links are common.

Two tokenizers cut a text at different byte offsets. Where both end a token is
a shared cut; the tokens between two cuts are a group. Cuts are found by divide
and conquer: of an interval, the common end nearest the middle is located by
bisecting the other tokenizer's ends, both halves go on, and an interval
without a cut inside is a group. All intervals of a level are taken together.

A link is a pair of tokens, one of each side, in one group. How many documents
hold an id pair linked is counted over the corpus: documents are aligned once,
in their scan task, and packed into chunks; a chunk sends its distinct id pairs
with their document counts to buckets of first ids, buckets sum them over parts
of the chunks and then in all, and every chunk gets the counts of its own pairs back.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import _CHUNKS_OF_TASK, chunked, pack_table, unpack_table
from .packed import (binary, pack_bits, pack_counts, pack_keys, parallelism, unpack_bits, unpack_counts, unpack_keys)
from .packing import tokenizer_path

CACHE_PIECES = 400_000        # pieces of text whose ids a worker keeps; beyond it the older half goes
CHUNK_BYTES = 3 << 20         # text aligned at a time
WIDE = 1 << 12                # links of a group above which equal ids are counted before pairing
TASKS_OF_PART = 1024          # scan tasks whose counts are summed first
_SCATTER = 40503              # odd: spreads neighbouring first ids over the buckets

# Fixed value: how the byte-level tokenizers part a text before merging.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_GRAPHIC, _LEAD = np.zeros(256, bool), np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
_LEAD[0xC3:0xE0] = True       # of two-byte characters, none of which is white space

_aligners: dict[tuple[str, str], Aligner] = {}


def _byte_of_symbol() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others
    for the code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """Ids of a text by a byte-level ``tokenizers`` file and a ``sentencepiece`` model.

    Both part a text before a single space or line break between two visible
    characters, so the ids of the pieces are those of the text; a piece's ids
    are kept for its next occurrence. Where a tokenizer does not part so,
    texts are one piece.
    """

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # Spark's tasks are the parallelism
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer
        self.a = a = Tokenizer.from_file(a_path)
        a.encode_special_tokens = True
        self.b = b = SentencePieceProcessor(model_file=b_path)
        symbol = _byte_of_symbol()
        self.a_bytes = [b""] * a.get_vocab_size(with_added_tokens=True)
        for token, i in a.get_vocab(with_added_tokens=True).items():
            self.a_bytes[i] = bytes(symbol[c] for c in token) if all(c in symbol for c in token) else token.encode()
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self.space = b.piece_to_id("▁")
        words = [x[0] for x in a.pre_tokenizer.pre_tokenize_str(" ab. cd\nef")] if a.pre_tokenizer else []
        plain = a.normalizer is None and words == ["Ġab", ".", "Ġcd", "Ċ", "ef"]
        self.fast = self._ranked(json.loads(a.to_str())["model"]) if plain else None
        self.parts = (plain and not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
                      and self._encode_b([b"\na b", b" \na"]) is not None)
        self.new, self.old = ({}, {}), ({}, {})
        self.odd: set[bytes] = set()

    def _ranked(self, model: dict):
        """The same byte-level merges as ranks, if they are: every id after the
        single bytes is that of the next merge."""
        if model["type"] != "BPE" or model.get("ignore_merges") or model.get("byte_fallback"):
            return None
        vocab, merges = model["vocab"], [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        made = [vocab.get(m.replace(" ", "", 1)) for m in merges]
        if made != list(range(256, 256 + len(made))) or len({self.a_bytes[i] for i in range(256)}) != 256:
            return None
        import tiktoken
        ranks = {self.a_bytes[i]: i for i in range(256 + len(made))}
        return tiktoken.Encoding("ranked", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})

    def _ids_a(self, text: str) -> list[int]:
        return self.fast.encode_ordinary(text) if self.fast else self.a.encode(text, add_special_tokens=False).ids

    def _encode_a(self, pieces: list[bytes]) -> list[bytes]:
        return [np.array(self._ids_a(p.decode()), "<u4").tobytes() for p in pieces]

    def _encode_b(self, pieces: list[bytes]) -> list[bytes] | None:
        """``b`` puts a space before a text: it is taken off, or, before a line break, its token is."""
        mid = [not p.startswith(b" ") for p in pieces]
        got = self.b.encode([p.decode() if m else p[1:].decode() for p, m in zip(pieces, mid)], num_threads=1)
        if any(m and (not ids or ids[0] != self.space) for m, ids in zip(mid, got)):
            return None
        return [np.array(ids[1:] if m else ids, "<u4").tobytes() for m, ids in zip(mid, got)]

    def _together(self, pieces: list[bytes]) -> tuple[list[bytes], list[bytes]] | None:
        """Ids of pieces that may follow one another, from one text of them all;
        None if some are not restored by their tokens."""
        pieces = [b" a", *pieces]
        text, ends, out = b"".join(pieces), np.cumsum([len(p) for p in pieces]), []
        for ids, table, lengths in ((self._ids_a(text.decode()), self.a_bytes, self.a_len),
                                    (self.b.encode(text[1:].decode(), num_threads=1), self.b_bytes, self.b_len)):
            raw = np.array(ids, "<u4")
            at = np.cumsum(lengths[raw])
            stops = np.searchsorted(at, ends)
            if at[-1] != len(text) or (at[stops] != ends).any() or b"".join([table[i] for i in ids]) != text:
                return None
            stops = ((stops + 1) * 4).tolist()
            raw = raw.tobytes()
            out.append([raw[i:j] for i, j in zip(stops, stops[1:])])
        return tuple(out)

    def pieces(self, text: bytes) -> list[bytes]:
        """Pieces of `` `` + text; a leading space is left out unless more white space follows it."""
        raw = np.frombuffer(text, np.uint8)
        if not self.parts or len(raw) < 3:
            return [b" " + text]
        lead = _LEAD[raw]
        begins = _GRAPHIC[raw] | lead
        ends = _GRAPHIC[raw]
        ends[1:] |= lead[:-1]
        gap = np.flatnonzero(((raw[1:-1] == 0x20) | (raw[1:-1] == 0x0A)) & ends[:-2] & begins[2:]) + 1
        lines = gap[raw[gap] == 0x0A]
        raw = raw.copy()
        raw[gap[raw[gap] == 0x20]] = 0xFF
        if len(lines):
            raw = np.insert(raw, lines, 0xFF)
        out = raw.tobytes().split(b"\xff")
        if not begins[0]:
            out[0] = b" " + out[0]
        return out

    def _learn(self, missing: set[bytes]) -> None:
        inner, outer = [], []       # pieces as they stand between others, and those with white space at an end
        for piece in missing:
            if piece in self.old[0]:
                for new, old in zip(self.new, self.old):
                    new[piece] = old[piece]
            elif self.parts and (_GRAPHIC[piece[-1]] or len(piece) > 1 and _LEAD[piece[-2]]) and piece[:1] != b" ":
                inner.append(piece)
            else:
                outer.append(piece)
        some = [inner[i:i + 20_000] for i in range(0, len(inner), 20_000)] + [outer[i:i + 1_000] for i in range(0, len(outer), 1_000)]
        for n, group in enumerate(some):
            full = [p if p[:1] in (b" ", b"\n") else b" " + p for p in group]
            ids = self._together(full) if n * 20_000 < len(inner) else None
            for piece, whole, x, y in zip(group, full, *(ids or (self._encode_a(full), self._encode_b(full)))):
                self.new[0][piece], self.new[1][piece] = x, y
                if not ids and not self.joined(x, self.a_bytes) == self.joined(y, self.b_bytes) == whole:
                    self.odd.add(piece)

    @staticmethod
    def joined(ids: bytes, table: list[bytes]) -> bytes:
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])

    def encode_many(self, texts: list[bytes]) -> list[tuple[bytes, bytes]]:
        """Packed ids of each text by both; empty for texts that are empty, not
        UTF-8, or not restored by either's token bytes."""
        if len(self.new[0]) > CACHE_PIECES // 2:
            self.old, self.new = self.new, ({}, {})
            self.odd &= self.old[0].keys()
        split, missing = [], set()
        for text in texts:
            try:
                text.decode()
                split.append(self.pieces(text) if text else [])
            except UnicodeDecodeError:
                split.append([])
            missing.update(split[-1])
        self._learn(missing - self.new[0].keys())
        out = []
        for text, pieces in zip(texts, split):
            a, b = (b"".join(map(known.__getitem__, pieces)) for known in self.new)
            if self.odd and not self.odd.isdisjoint(pieces) and not (
                    self.joined(a, self.a_bytes) == self.joined(b, self.b_bytes) == b" " + text):
                a = b = b""
            out.append((a, b))
        return out


def aligner(a: str, b: str) -> Aligner:
    """The worker's aligner for two files, loaded once."""
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


def groups(a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups begin, as indexes into both sides' tokens, with the ends at last.

    ``a_ends`` and ``b_ends`` are rising byte offsets; text ``i`` has the tokens
    ``a_cuts[i]:a_cuts[i + 1]`` and ``b_cuts[i]:b_cuts[i + 1]``, both ending alike.
    """
    a_lo, a_hi, b_lo, b_hi = a_cuts[:-1], a_cuts[1:], b_cuts[:-1], b_cuts[1:]
    some = a_hi > a_lo
    level = tuple(x[some] for x in (a_lo, a_hi, b_lo, b_hi))
    done = []
    while len(level[0]):
        a_lo, a_hi, b_lo, b_hi = level
        at, other = np.full(len(a_lo), -1), np.zeros(len(a_lo), np.int64)
        left = np.flatnonzero((a_hi - a_lo > 1) & (b_hi - b_lo > 1))
        step = 0
        while len(left):
            first, last = a_lo[left], a_hi[left] - 2        # the last token ends the interval itself
            middle = (first + last) >> 1
            for probe in ((middle,) if not step else (middle + step, middle - step)):
                inside = (probe >= first) & (probe <= last) & (at[left] < 0)
                where, token = left[inside], probe[inside]
                found = np.searchsorted(b_ends, a_ends[token])
                same = b_ends[found] == a_ends[token]
                at[where[same]], other[where[same]] = token[same], found[same]
            step += 1
            left = left[(at[left] < 0) & ((middle + step <= last) | (middle - step >= first))]
        leaf = at < 0
        done.append((a_lo[leaf], b_lo[leaf]))
        cut = ~leaf
        a, b = at[cut] + 1, other[cut] + 1
        level = (np.concatenate([a_lo[cut], a]), np.concatenate([a, a_hi[cut]]),
                 np.concatenate([b_lo[cut], b]), np.concatenate([b, b_hi[cut]]))
    a = np.sort(np.concatenate([x for x, _ in done] + [a_cuts[-1:]]))
    b = np.sort(np.concatenate([x for _, x in done] + [b_cuts[-1:]]))
    return a, b


def link_pairs(a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All links of the groups that begin at ``a_at`` and ``b_at``: their group,
    both ids, and how often; in groups of very many links, equal ones as one."""
    n_a, n_b = np.diff(a_at), np.diff(b_at)
    each = n_a * n_b
    narrow = each <= WIDE
    tokens = np.repeat(np.where(narrow, n_b, 0), n_a)             # links of each a token
    left = np.repeat(np.arange(len(a)), tokens)
    group = np.repeat(np.arange(len(n_a)), np.where(narrow, each, 0))
    begin = np.cumsum(tokens) - tokens
    right = np.arange(len(left)) - np.repeat(begin, tokens) + b_at[group]
    out = [(group, a[left], b[right], np.ones(len(left), np.int64))]
    for g in np.flatnonzero(~narrow).tolist():
        x, nx = np.unique(a[a_at[g]:a_at[g + 1]], return_counts=True)
        y, ny = np.unique(b[b_at[g]:b_at[g + 1]], return_counts=True)
        out.append((np.full(len(x) * len(y), g), np.repeat(x, len(y)), np.tile(y, len(x)), np.outer(nx, ny).ravel()))
    return tuple(np.concatenate(x) for x in zip(*out))


class Digits:
    """Decimal spellings of ids, put together as bytes."""

    def __init__(self, size: int):
        self.width = len(str(size - 1))
        powers = 10 ** np.arange(self.width)[::-1]
        digits = np.arange(size)[:, None] // powers % 10
        self.text = np.full((size, self.width + 1), 0x2C, np.uint8)
        self.text[:, :-1] = digits + 0x30
        self.shown = np.ones((size, self.width + 1), bool)
        self.shown[:, :-1] = np.maximum.accumulate(digits > 0, axis=1)
        self.shown[:, -2] = True

    def groups(self, a: np.ndarray, b: np.ndarray, a_at: np.ndarray, b_at: np.ndarray) -> tuple[bytes, np.ndarray]:
        """``a1,a2|b1;a3|b2;...`` of all groups, and where each begins in it (and the whole ends)."""
        n_a, n_b = np.diff(a_at), np.diff(b_at)
        ids = np.empty(len(a) + len(b), np.int64)
        ids[np.arange(len(a)) + np.repeat(b_at[:-1], n_a)] = a
        ids[np.arange(len(b)) + np.repeat(a_at[1:], n_b)] = b
        text, shown = self.text[ids], self.shown[ids]
        text[a_at[1:] + b_at[:-1] - 1, -1] = 0x7C
        text[a_at[1:] + b_at[1:] - 1, -1] = 0x3B
        ends = np.concatenate([[0], np.cumsum(shown.sum(axis=1))])
        return text[shown].tobytes(), ends[a_at + b_at]


def _aligned(table: pa.Table, tools: Aligner):
    """Per row: ids by both, joined; the rows' bounds; the groups' starts and the rows' bounds among them."""
    both = tools.encode_many([x or b"" for x in table["text"].cast(pa.binary()).to_pylist()])
    a, b = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in zip(*both))
    a_cuts, b_cuts = (np.cumsum([0, *(len(x) // 4 for x in side)]) for side in zip(*both))
    a_at, b_at = groups(np.cumsum(tools.a_len[a]), np.cumsum(tools.b_len[b]), a_cuts, b_cuts)
    return a, b, a_cuts, b_cuts, a_at, b_at, np.searchsorted(a_at, a_cuts)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model",
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The groups themselves, one row per input row: ``doc_id, groups``, an array
    of ``struct<a array<int>, b array<int>>`` with the ids of either side."""
    src = _source(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tools = aligner(tokenizer_path(a), tokenizer_path(b))
        for batch in batches:
            if not batch.num_rows:
                continue
            ids_a, ids_b, _, _, a_at, b_at, rows = _aligned(pa.Table.from_batches([batch]), tools)
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
                     for ids, at in ((ids_a, a_at), (ids_b, b_at))]
            pairs = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.StructArray.from_arrays(lists, names=["a", "b"]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pairs], names=["doc_id", "groups"])

    return src.mapInArrow(run, f"doc_id {kind}, groups array<struct<a: array<int>, b: array<int>>>")


def link_counts(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model",
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``.

    ``a`` and ``b`` name files of ``public_tokenizers`` or are absolute paths.
    The text is taken with a space before it. A link's count is the number of
    rows that hold its id pair linked; it is best if no pair of its ``a`` id
    has a higher one. ``groups_sha256`` digests ``a1,a2|b1;a3|b2`` (ids in order).

    Null or empty texts, and those that the bytes of either side's tokens do not
    restore, have no tokens: zeros, and an empty digest. Repeated rows and
    null ids are documents like any other; other columns are ignored, whatever
    their names; an empty table gives no rows.
    """
    src = _source(docs, id_col, text_col)
    kind = src.schema["doc_id"].dataType.simpleString()
    buckets = min(parallelism(docs.sparkSession), 1 << 12)

    def pack(table):
        tools = aligner(tokenizer_path(a), tokenizer_path(b))
        spread = 1 << max(1, (len(tools.a_bytes) - 1).bit_length())
        if spread * len(tools.b_bytes) > 1 << 32:
            raise ValueError("the vocabularies' id pairs exceed 32 bits")
        ids_a, ids_b, a_cuts, b_cuts, a_at, b_at, rows = _aligned(table, tools)
        spelt, begins = Digits(max(len(tools.a_bytes), len(tools.b_bytes))).groups(ids_a, ids_b, a_at, b_at)
        bounds = begins[rows].tolist()
        sha = [hashlib.sha256(spelt[i:j - 1]).hexdigest() if j > i else "" for i, j in zip(bounds, bounds[1:])]
        links = np.concatenate([[0], np.cumsum(np.diff(a_at) * np.diff(b_at))])[rows]
        group, x, y, times = link_pairs(ids_a, ids_b, a_at, b_at)
        row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))[group]
        pair = (x * _SCATTER % spread) * len(tools.b_bytes) + y
        keys = row << 32 | pair
        if times.max(initial=1) == 1:
            keys, times = np.unique(keys, return_counts=True)
        else:
            keys, at = np.unique(keys, return_inverse=True)
            times = np.bincount(at, times).astype(np.int64)
        distinct, at, held = np.unique(keys & 0xFFFFFFFF, return_inverse=True, return_counts=True)
        cuts = np.searchsorted(keys, np.arange(len(rows)) << 32).tolist()
        spans = list(zip(cuts, cuts[1:]))
        at = at.astype(np.uint32)
        out = pa.table({"doc_id": table["doc_id"], "n_a": np.diff(a_cuts), "n_b": np.diff(b_cuts), "n_groups": np.diff(rows),
                        "n_links": np.diff(links), "groups_sha256": sha,
                        "pairs": binary([pack_keys(at[i:j]) for i, j in spans]),
                        "times": binary([pack_counts(times[i:j]) for i, j in spans])})
        return pack_table(out), pack_keys(distinct.astype(np.uint32)), pack_counts(held), spread * len(tools.b_bytes), len(tools.b_bytes)

    chunks = chunked(src, "docs binary, pairs binary, held binary, span long, row long", pack, CHUNK_BYTES)

    def send(key, table):
        one = table.select(["chunk", "pairs", "held", "span", "row"]).to_pylist()[0]
        pairs = unpack_keys(one["pairs"])
        held = unpack_counts(one["held"], len(pairs))
        first = pairs.astype(np.int64) // one["row"]                    # scattered a ids; equal ones share a bucket
        edges = np.searchsorted(first * buckets // (one["span"] // one["row"]), np.arange(buckets + 1))
        spans = [(k, i, j) for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        many = len(spans)
        return pa.table({"bucket": pa.array([k for k, _, _ in spans], pa.int32()),
                         "part": pa.array([one["chunk"] // _CHUNKS_OF_TASK // TASKS_OF_PART] * many, pa.int32()),
                         "chunk": pa.array([one["chunk"]] * many, pa.int64()), "row": pa.array([one["row"]] * many, pa.int64()),
                         "n": pa.array([j - i for _, i, j in spans], pa.int64()),
                         "pairs": binary([pack_keys(pairs[i:j]) for _, i, j in spans]),
                         "held": binary([pack_counts(held[i:j]) for _, i, j in spans])})

    sent = chunks.groupBy("chunk").applyInArrow(
        send, "bucket int, part int, chunk long, row long, n long, pairs binary, held binary")

    def summed(table):
        pairs = [unpack_keys(x) for x in table["pairs"].to_pylist()]
        held = [unpack_counts(x, len(p)) for x, p in zip(table["held"].to_pylist(), pairs)]
        keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, np.concatenate(held))
        return keys, total

    def summary(key, table, best):
        """A bucket's sums, once for every part that is among its rows."""
        keys, total = summed(table)
        parts = sorted(set(table["part"].to_pylist()))
        row = table["row"][0].as_py()
        flags = np.zeros(0, bool)
        if best and len(keys):
            first = keys.astype(np.int64) // row
            new = np.flatnonzero(np.diff(first, prepend=-1))
            flags = total == np.repeat(np.maximum.reduceat(total, new), np.diff(np.append(new, len(keys))))
        many = len(parts)
        return pa.table({"bucket": pa.array([key[0].as_py()] * many, pa.int32()), "part": pa.array(parts, pa.int32()),
                         "row": pa.array([row] * many, pa.int64()), "pairs": binary([pack_keys(keys)] * many),
                         "held": binary([pack_counts(total)] * many), "best": binary([pack_bits(flags)] * many)})

    columns = "bucket int, part int, row long, pairs binary, held binary, best binary"
    partial = sent.groupBy("bucket", "part").applyInArrow(lambda key, table: summary(key, table, False), columns)
    totals = partial.groupBy("bucket").applyInArrow(lambda key, table: summary(key, table, True), columns)

    def answer(key, left, right):
        one = right.to_pylist()[0]
        keys = unpack_keys(one["pairs"])
        held, best = unpack_counts(one["held"], len(keys)), unpack_bits(one["best"], len(keys))
        at = [np.searchsorted(keys, unpack_keys(x)) for x in left["pairs"].to_pylist()]
        return pa.table({"chunk": left["chunk"], "bucket": left["bucket"], "n": left["n"],
                         "held": binary([pack_counts(held[i]) for i in at]), "best": binary([pack_bits(best[i]) for i in at])})

    answers = sent.groupBy("bucket", "part").cogroup(totals.groupBy("bucket", "part")).applyInArrow(
        answer, "chunk long, bucket int, n long, held binary, best binary")

    def finish(key, left, right):
        table = unpack_table(left["docs"][0].as_py())
        right = right.sort_by("bucket")
        sizes = right["n"].to_pylist()
        held = np.concatenate([*(unpack_counts(x, n) for x, n in zip(right["held"].to_pylist(), sizes)), np.zeros(0, np.int64)])
        best = np.concatenate([*(unpack_bits(x, n) for x, n in zip(right["best"].to_pylist(), sizes)), np.zeros(0, bool)])
        n_best, count_sum = [], []
        for pairs, times in zip(table["pairs"].to_pylist(), table["times"].to_pylist()):
            at = unpack_keys(pairs)
            times = unpack_counts(times, len(at))
            n_best.append(int(times[best[at]].sum()))
            count_sum.append(int((times * held[at]).sum()))
        return pa.table([*(table[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")),
                         pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), table["groups_sha256"]], names=names)

    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
