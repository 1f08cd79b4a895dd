"""Quality rules: counts per document, and a hashed n-gram likelihood ratio.

Two multinomials over word n-grams, each under its own 64-bit hash: the trusted
target (texts labelled as good) and the raw corpus (all texts). A document's
score is the mean, over its n-grams, of log p(target) - log p(raw); every
document at or above one fixed threshold is kept.

The target is smoothed by the raw shares, with a mass that is a fixed share of
its own size: an n-gram that no trusted text holds has one constant ratio,
whatever the size of the corpus or of the target.

Texts are packed into chunks, where they lie. A chunk sends its distinct n-grams,
sorted and packed, to buckets by their upper bits; a bucket sums them over all
chunks and sends each chunk one bit per n-gram, whether another chunk has it,
and the counts of those; of the others the chunk's own counts are the corpus's.
All passes read one exchange of the compressed texts. Nothing is gathered: the
driver and the tasks hold no table that grows with the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunked, pack_table, unpack_table
from .packed import (binary, bucket_bits, bucket_edges, pack_bits, pack_counts, pack_hashes, squeezed, unpack_bits,
                     unpack_counts, unpack_hashes, unsqueezed)
from .words import window_hashes, word_hashes

KEY_BITS = 34                # of an n-gram's hash, beside those that name its bucket
CHUNK_BYTES = 36 << 20       # text counted at a time
ZSTD_LEVEL = 6               # of the texts in their exchange
ORDERS = (1, 2)              # word n-grams counted and scored
THRESHOLD = -0.25            # mean log ratio a document must reach
PRIOR = 1.8                  # mass of the raw shares in the target, as a share of the target's own
MIN_WORDS, MAX_REPEAT_PCT, REPEAT_WORDS = 50, 50, 3

_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_CODE_POINT = np.ones(256, np.int64)
_CODE_POINT[0x80:0xC0] = 0          # UTF-8 continuation bytes
_CODE_POINT[[0x20, *range(0x09, 0x0E)]] = 0
_LINE_SPACE = b" \t\r\x0b\x0c"


def statistics(text: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    raw = np.frombuffer(text, np.uint8)
    seen, dup = set(), 0
    for line in text.split(b"\n"):
        if line.strip(_LINE_SPACE):
            dup += line in seen
            seen.add(line)
    repeat = 0
    grams = window_hashes(words, REPEAT_WORDS)
    if len(grams):
        order = np.argsort(grams)
        g = grams[order]
        same = np.zeros(len(g) + 1, bool)
        same[1:-1] = g[1:] == g[:-1]
        start = np.zeros(len(words) + 1, np.int64)
        hit = order[same[1:] | same[:-1]]
        np.add.at(start, hit, 1)
        np.add.at(start, hit + REPEAT_WORDS, -1)
        repeat = int((np.cumsum(start)[:-1] > 0).sum())
    return len(words), int(_CODE_POINT[raw].sum()), int(_SYMBOLS[raw].sum()), dup, repeat


def ngram_keys(words: np.ndarray, bits: int) -> np.ndarray:
    """The upper ``bits`` of the 64-bit hash of every n-gram, all orders after another."""
    return np.concatenate([window_hashes(words, n) for n in ORDERS]) >> np.uint64(64 - bits)


def log_ratios(raw: np.ndarray, target: np.ndarray, raw_sum: int, target_sum: int) -> np.ndarray:
    """log p(target) - log p(raw) per n-gram of the corpus; zeros without any target."""
    if not target_sum:
        return np.zeros(len(raw))
    p = raw / raw_sum
    return np.log((target / target_sum + PRIOR * p) / (1 + PRIOR)) - np.log(p)


def _texts(table: pa.Table) -> list[bytes]:
    return [x or b"" for x in table["text"].cast(pa.binary()).to_pylist()]


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and their counts; sorts in place, since the arrays are large."""
    grams.sort()
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1])) if len(grams) else np.zeros(0, np.int64)
    return grams[first], np.diff(np.append(first, len(grams)))


def _counted(grams: np.ndarray, sizes: list[int], trusted: list[bool]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams of texts laid end to end, sorted, and how often all and the trusted ones hold each."""
    good, n = _distinct(grams[np.repeat(np.array(trusted, bool), sizes)])
    keys, raw = _distinct(grams.copy())
    target = np.zeros(len(keys), np.int64)
    target[np.searchsorted(keys, good)] = n
    return keys, raw, target


def _laid(grams: list[np.ndarray]) -> tuple[np.ndarray, list[int]]:
    return np.concatenate([*grams, np.zeros(0, np.uint64)]), [len(g) for g in grams]


_SENT = "bucket int, chunk long, n long, keys binary, raw binary, target binary"
_ANSWERS = "chunk long, bucket int, n long, shared binary, raw binary, target binary"


def ngram_counts(chunks: DataFrame, marks: DataFrame, bits: int) -> DataFrame:
    """Per chunk and bucket: which of the chunk's distinct n-grams, in order, other
    chunks have too, the raw and target counts of these over all rows, and the
    corpus's sums. ``marks(holder, held)`` are the trusted ids by chunk."""
    def send(key, left, right):
        table = unpack_table(left["docs"][0].as_py())
        trusted = pc.is_in(table["doc_id"], value_set=right["held"].combine_chunks()).to_pylist()
        keys, raw, target = _counted(*_laid([ngram_keys(word_hashes(t), bits + KEY_BITS) for t in _texts(table)]), trusted)
        edges = bucket_edges(keys >> np.uint64(KEY_BITS), bits)
        spans = [(k, i, j) for k, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        return pa.table({"bucket": pa.array([k for k, _, _ in spans], pa.int32()),
                         "chunk": pa.array([key[0].as_py()] * len(spans), pa.int64()),
                         "n": pa.array([j - i for _, i, j in spans], pa.int64()),
                         "keys": squeezed([pack_hashes(keys[i:j]) for _, i, j in spans]),
                         "raw": squeezed([pack_counts(raw[i:j]) for _, i, j in spans]),
                         "target": squeezed([pack_counts(target[i:j]) for _, i, j in spans])})

    def answer(key, table):
        parts = [unpack_hashes(x) for x in unsqueezed(table["keys"])]
        cuts = np.cumsum([len(x) for x in parts])[:-1]
        keys, at, holders = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = np.split((holders > 1)[at], cuts)
        totals = []
        for name in ("raw", "target"):
            own = np.concatenate([unpack_counts(x, len(p)) for x, p in zip(unsqueezed(table[name]), parts)])
            total = np.zeros(len(keys), np.int64)
            np.add.at(total, at, own)
            totals.append(squeezed([pack_counts(x[s]) for x, s in zip(np.split(total[at], cuts), shared)]))
        return pa.table([table["chunk"], table["bucket"], table["n"], binary([pack_bits(s) for s in shared]), *totals],
                        names=["chunk", "bucket", "n", "shared", "raw", "target"])

    sent = chunks.groupBy("chunk").cogroup(marks.groupBy("holder")).applyInArrow(send, _SENT)
    return sent.groupBy("bucket").applyInArrow(answer, _ANSWERS)


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, trusted_rows: int | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, score, kept``.

    ``trusted`` holds the ids of trusted documents in its one column; every row
    of ``docs`` with such an id counts in the target, unless the caller asks for
    ``trusted_rows`` ids only (those with the smallest hashes). The raw corpus
    is every row of ``docs``. ``kept`` is false if a
    base rule fails, else whether ``score`` reaches ``threshold``; without any
    trusted text all scores are 0. Two n-grams count as one if their hashes agree
    in the bits of the bucket and ``KEY_BITS`` more.

    Null or empty text has zero counts, score 0 and fails the base rule. Null
    ids are never trusted; repeated rows count each time. Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType.simpleString()
    bits = bucket_bits(docs.sparkSession)
    chunks = chunked(src, "docs binary", lambda table: (pack_table(table, ZSTD_LEVEL),), CHUNK_BYTES)
    ids = trusted.select(F.col(f"`{trusted.columns[0]}`").alias("trusted")).where("trusted IS NOT NULL").distinct()
    if trusted_rows is not None:
        ids = ids.orderBy(F.xxhash64("trusted"), "trusted").limit(trusted_rows)

    def ids_of(key, table):
        table = unpack_table(table["docs"][0].as_py())
        n = np.array([len(t.split()) for t in _texts(table)], np.int64)
        grams = sum(np.maximum(n - k + 1, 0) for k in ORDERS)
        table = pa.table({"held": table["doc_id"], "n": grams}).group_by("held").aggregate([("n", "sum")])
        return pa.table([pa.array([key[0].as_py()] * len(table), pa.int64()), table["held"], table["n_sum"]], names=["holder", "held", "n"])

    held = chunks.groupBy("chunk").applyInArrow(ids_of, f"holder long, held {kind}, n long")
    marks = held.join(ids, held.held == ids.trusted, "left_semi")
    sums = [some.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar().alias(name)
            for some, name in ((held, "raw_sum"), (marks, "target_sum"))]
    marks = marks.select("holder", "held")

    def run(key, left, right):
        table = unpack_table(left["docs"][0].as_py())
        marked = pc.is_valid(right["held"])
        good = pc.is_in(table["doc_id"], value_set=right["held"].filter(marked).combine_chunks()).to_pylist()
        right = right.filter(pc.invert(marked)).sort_by("bucket")
        texts = _texts(table)
        words = [word_hashes(t) for t in texts]
        grams, lengths = _laid([ngram_keys(w, bits + KEY_BITS) for w in words])
        keys, *own = _counted(grams, lengths, good)
        sizes = right["n"].to_pylist()
        if sum(sizes) != len(keys):
            raise ValueError(f"chunk {key[0]} has {len(keys)} n-grams, of which {sum(sizes)} were counted")
        ratio = np.zeros(0)
        if sizes:
            bits_of = [unpack_bits(x, n) for x, n in zip(right["shared"].to_pylist(), sizes)]
            shared = np.concatenate(bits_of)
            for counts, name in zip(own, ("raw", "target")):
                counts[shared] = np.concatenate([unpack_counts(x, int(s.sum()))
                                                 for x, s in zip(unsqueezed(right[name]), bits_of)])
            ratio = log_ratios(*own, right["raw_sum"][0].as_py(), right["target_sum"][0].as_py())
        rows, begin = [], 0
        for text, w, size in zip(texts, words, lengths):
            n, chars, symbols, dup, repeat = statistics(text, w)
            failed = n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PCT * n
            score = float(ratio[np.searchsorted(keys, grams[begin:begin + size])].mean()) if n else 0.0
            begin += size
            rows.append((n, chars, symbols, dup, repeat, failed, score, not failed and score >= threshold))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
        return pa.table([table["doc_id"], *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))], names=names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    told = ngram_counts(chunks, marks, bits).select("*", *sums).unionByName(
        marks.select(F.col("holder").alias("chunk"), "held"), allowMissingColumns=True)
    return chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        run, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
             "n_repeat_words long, base_failed boolean, score double, kept boolean")
