"""Exact substring removal by fixed-block anchors.

Every repeat of ``window`` words contains, in each of its places, one whole
block of ``(window + 1) // 2`` words that starts at a multiple of that length.
So three passes over the documents, dealt into chunks by one text exchange
that all passes reuse, find every repeat:

1. *Index and probe.* A chunk hashes every rolling block-long window and marks
   the aligned ones (the non-overlapping reference blocks). The distinct
   hashes go to buckets as compact blobs. A bucket answers, one bit per hash
   sent: is this hash a reference block somewhere and present elsewhere too?
2. *Extend.* Around each hit a chunk extends to all full windows that hold the
   hit, and sends their distinct 96-bit hashes. A bucket answers which occur in
   another chunk; repeats inside a chunk are seen there.
3. *Cover.* Runs of repeated windows are the maximal exact repeats; the words
   they cover are removed.

A chunk sends a hash once however often it occurs there, so a passage in a
third of all documents costs a bucket one entry per chunk and no pairs are
ever formed. The first pass keeps 32 bits beside the bucket number: a chance
match there only makes a window a candidate, which the 96 bits of the second
pass decide. Nothing is collected; lost tasks recompute from the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packed import (binary, bucket_bits, bucket_edges, pack_bits, pack_keys, parallelism,
                     unpack_bits, unpack_keys)
from .words import window_hashes, word_hashes, word_spans

_SENT = "bucket int, chunk long, keys binary, more binary"
_ANSWER = "chunk long, step int, bucket int, hits binary"
_OUT = ("doc_id {id}, n_words long, n_removed long, "
        "removed array<struct<start:long,end:long>>, kept_text string")


class _Chunk:
    """The words and window hashes of one chunk's documents, in row order."""

    def __init__(self, table: pa.Table, window: int, bits: int):
        self.window, self.block, self.bits = window, (window + 1) // 2, bits
        texts = table["text"].cast(pa.binary()).to_pylist()
        self.words = [word_hashes(x or b"") for x in texts]
        self.texts = texts
        probes = [window_hashes(w, self.block) for w in self.words]
        self.ends = np.cumsum([len(p) for p in probes])
        self.probe = np.concatenate(probes or [np.zeros(0, np.uint64)]) >> np.uint64(32 - bits)
        aligned = [np.arange(len(p)) % self.block == 0 for p in probes]
        self.aligned = np.concatenate(aligned or [np.zeros(0, bool)])

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct probe keys, whether each is aligned somewhere here, and
        whether it occurs here more than once."""
        if not len(self.probe):
            return np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, bool)
        both = np.sort((self.probe << np.uint64(1)) | ~self.aligned)  # aligned ones first
        keys = both >> np.uint64(1)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        return keys[first], (both[first] & np.uint64(1)) == 0, np.diff(first, append=len(keys)) > 1

    def candidates(self, answers: dict[int, bytes]) -> tuple[list, np.ndarray, np.ndarray]:
        """Per document the starts of windows that hold an anchor hit; and the
        two hash lanes of all of them, in that order."""
        keys, aligned, several = self.anchors()
        hit = aligned & several
        edges = bucket_edges(keys >> np.uint64(32), self.bits)
        for b, blob in answers.items():
            hit[edges[b]:edges[b + 1]] |= unpack_bits(blob, edges[b + 1] - edges[b])
        found = keys[hit]
        if len(found):
            at = np.searchsorted(found, self.probe)
            at[at == len(found)] = 0
            is_hit = found[at] == self.probe
        else:
            is_hit = np.zeros(len(self.probe), bool)
        starts, lanes = [], ([], [])
        begin = 0
        for words, end in zip(self.words, self.ends):
            own = is_hit[begin:end]
            begin = end
            n = len(words) - self.window + 1
            if n <= 0 or not own.any():
                starts.append(np.zeros(0, np.int64))
                continue
            before = np.concatenate([[0], np.cumsum(own)])
            span = self.window - self.block + 1
            at = np.flatnonzero(before[span:span + n] > before[:n])
            starts.append(at)
            for lane in (0, 1):
                lanes[lane].append(window_hashes(words, self.window, lane)[at])
        both = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in lanes]
        return starts, both[0], (both[1] >> np.uint64(32)).astype(np.uint32)


def _distinct(high: np.ndarray, low: np.ndarray):
    """Order that sorts (high, low), first index of each group in it, and group sizes."""
    order = np.lexsort((low, high))
    h, x = high[order], low[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (x[1:] != x[:-1])
    first = np.flatnonzero(new)
    return order, first, np.diff(first, append=len(h))


def _rows(chunk: int, parts: Iterator[tuple[int, bytes, bytes]]) -> pa.Table:
    got = list(parts)
    return pa.table({"bucket": pa.array([g[0] for g in got], pa.int32()),
                     "chunk": pa.array([chunk] * len(got), pa.int64()),
                     "keys": binary([g[1] for g in got]), "more": binary([g[2] for g in got])})


def _answers(step: int, bucket: int, table: pa.Table, hits: list[np.ndarray]) -> pa.Table:
    some = [i for i, h in enumerate(hits) if h.any()]
    return pa.table({"chunk": table["chunk"].combine_chunks().take(pa.array(some, pa.int64())),
                     "step": pa.array([step] * len(some), pa.int32()),
                     "bucket": pa.array([bucket] * len(some), pa.int32()),
                     "hits": binary([pack_bits(hits[i]) for i in some])})


def _split(flags: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    return np.split(flags, np.cumsum(sizes)[:-1])


def _steps(right: pa.Table) -> tuple[dict, dict]:
    got = ({}, {})
    for step, b, blob in zip(right["step"].to_pylist(), right["bucket"].to_pylist(), right["hits"].to_pylist()):
        got[step - 1][b] = blob
    return got


def remove_repeats(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Remove every word covered by a ``window``-word sequence that occurs elsewhere too.

    One row per input row: ``doc_id``, ``n_words``, ``n_removed``, ``removed``
    (maximal runs of removed words, end exclusive) and ``kept_text`` (the
    remaining words joined by one space). Windows are judged on the input, and
    "elsewhere" includes another place of the same document; overlapping places
    count.

    Null or empty text has no words: 0, 0, no runs, empty kept text. Texts
    under ``window`` words keep all. Repeated rows (also of one id, or of a null
    id) are separate documents, so their windows repeat each other. Other
    columns are ignored, whatever their names. An empty table gives no rows.
    """
    if window < 2:
        raise ValueError("window must be at least 2 words")
    spark = docs.sparkSession
    bits, chunks = bucket_bits(spark), 2 * parallelism(spark)
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    src = src.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def send_anchors(key, table):
        keys, aligned, _ = _Chunk(table, window, bits).anchors()
        edges = bucket_edges(keys >> np.uint64(32), bits)
        return _rows(key[0].as_py(), (
            (b, pack_keys(keys[i:j].astype(np.uint32)), pack_bits(aligned[i:j]))
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i))

    def answer_anchors(key, table):
        keys = [unpack_keys(x) for x in table["keys"].to_pylist()]
        sizes = [len(k) for k in keys]
        marks = [unpack_bits(x, n) for x, n in zip(table["more"].to_pylist(), sizes)]
        both = np.concatenate(keys).astype(np.uint64) << np.uint64(32)
        both = np.sort(both | np.arange(len(both), dtype=np.uint64))
        at = (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
        both >>= np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
        count = np.diff(first, append=len(both))
        hit = (count > 1) & np.logical_or.reduceat(np.concatenate(marks)[at], first)
        flags = np.zeros(len(both), bool)
        flags[at] = np.repeat(hit, count)
        return _answers(1, key[0].as_py(), table, _split(flags, sizes))

    def send_windows(key, left, right):
        _, high, low = _Chunk(left, window, bits).candidates(_steps(right)[0])
        order, first, _ = _distinct(high, low)
        high, low = high[order][first], low[order][first]
        edges = bucket_edges(high >> np.uint64(64 - bits), bits)
        return _rows(key[0].as_py(), (
            (b, high[i:j].astype("<u8").tobytes(), low[i:j].astype("<u4").tobytes())
            for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i))

    def answer_windows(key, table):
        highs = [np.frombuffer(x, "<u8") for x in table["keys"].to_pylist()]
        lows = [np.frombuffer(x, "<u4") for x in table["more"].to_pylist()]
        order, _, count = _distinct(np.concatenate(highs), np.concatenate(lows))
        flags = np.zeros(len(order), bool)
        flags[order] = np.repeat(count > 1, count)
        return _answers(2, key[0].as_py(), table, _split(flags, [len(h) for h in highs]))

    def cover(key, left, right):
        chunk = _Chunk(left, window, bits)
        anchors, windows = _steps(right)
        starts, high, low = chunk.candidates(anchors)
        order, first, count = _distinct(high, low)
        again = count > 1
        edges = bucket_edges(high[order][first] >> np.uint64(64 - bits), bits)
        for b, blob in windows.items():
            again[edges[b]:edges[b + 1]] |= unpack_bits(blob, edges[b + 1] - edges[b])
        repeated = np.zeros(len(order), bool)
        repeated[order] = np.repeat(again, count)
        out, begin = [], 0
        for doc_id, text, words, at in zip(left["doc_id"].to_pylist(), chunk.texts, chunk.words, starts):
            hit = at[repeated[begin:begin + len(at)]]
            begin += len(at)
            text = text or b""
            if len(hit):
                change = np.zeros(len(words) + 1, np.int64)
                np.add.at(change, hit, 1)
                np.add.at(change, hit + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                bounds = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                runs = [{"start": s, "end": e} for s, e in bounds.reshape(-1, 2).tolist()]
                begins, ends = word_spans(text)
                kept = b" ".join([text[i:j] for i, j in zip(begins[~gone].tolist(), ends[~gone].tolist())])
                out.append((doc_id, len(words), int(gone.sum()), runs, kept.decode()))
            else:
                out.append((doc_id, len(words), 0, [], b" ".join(text.split()).decode()))
        cols = list(zip(*out))
        kinds = [left["doc_id"].type, pa.int64(), pa.int64(),
                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)],
                        names=["doc_id", "n_words", "n_removed", "removed", "kept_text"])

    anchors = (src.groupBy("chunk").applyInArrow(send_anchors, _SENT)
               .groupBy("bucket").applyInArrow(answer_anchors, _ANSWER))
    windows = (src.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(send_windows, _SENT)
               .groupBy("bucket").applyInArrow(answer_windows, _ANSWER))
    out = _OUT.format(id=src.schema["doc_id"].dataType.simpleString())
    return (src.groupBy("chunk").cogroup(anchors.unionByName(windows).groupBy("chunk"))
            .applyInArrow(cover, out))
