"""Ranked lexical search: best-first over document intervals, bounded by range maxima.

Scores are sums of integer term impacts. A shard holds the posting lists of
the queries' terms over a bounded number of documents, and over every list a
sparse table for range-maximum queries. The search of a query begins with the
whole shard as one interval; the sum of its terms' range maxima bounds every
score in it. The interval of the highest bound is split at the document of its
largest single impact: that document is scored, and both remainders get
bounds of their own, until no bound reaches the kth score so far (ties: the
smallest id that the interval holds decides). Several of the best intervals are
split at a time, so that the work is a few array operations.

Two passes over the documents, no shuffle of texts: the first counts documents,
terms and document frequencies, the second indexes and searches shard after
shard, where a task carries each query's kth score from one shard to the next.
A task returns its k best per query. Queries are taken in blocks of bounded volume.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

SHARD_DOCS = 1 << 12          # documents of a shard at most; also the width of a document's place in a key
SHARD_POSTINGS = 1 << 19      # postings after which a shard is closed
BLOCK_BYTES = 8 << 20         # query text of a block
BATCH = 512                   # intervals split at a time at most
NO_ID = (1 << 63) - 1         # a null id comes last among equal scores

_BITS = 12
_FOLD = bytes(c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
              for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and non-ASCII characters, only A-Z lower-cased."""
    return text.translate(_FOLD).split()


def _texts(batch) -> list[bytes]:
    return [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]


def range_maxima(keys: np.ndarray, longest: int) -> np.ndarray:
    """Sparse table: row j holds the maximum of the 2^j keys from each place on."""
    rows = [keys]
    for j in range(max(0, longest.bit_length() - 1)):
        half = rows[-1].copy()
        step = 1 << j
        if step < len(keys):
            np.maximum(half[:-step], rows[-1][step:], out=half[:-step])
        rows.append(half)
    return np.stack(rows)


_LOG = np.zeros(SHARD_DOCS + 2, np.int64)
for _i in range(2, len(_LOG)):
    _LOG[_i] = _LOG[_i // 2] + 1


class Shard:
    """Posting lists of a bounded number of documents, with their sparse tables.

    ``docs`` and ``ids_of_terms`` are the postings (any order), ``impacts`` theirs.
    Documents are placed by falling total impact, then id, so that an interval
    holds documents of like weight and copies stand together.
    """

    def __init__(self, ids: np.ndarray, docs: np.ndarray, of_terms: np.ndarray, impacts: np.ndarray):
        n = self.n = len(ids)
        total = np.bincount(docs, impacts, n)
        order = np.lexsort((ids, -total))
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids = ids[order]
        docs = place[docs]
        sort = np.lexsort((docs, of_terms))
        self.docs, of_terms, impacts = docs[sort], of_terms[sort], impacts[sort]
        self.terms, self.starts = np.unique(of_terms, return_index=True)
        self.ends = np.append(self.starts[1:], len(of_terms))
        longest = int((self.ends - self.starts).max(initial=0))
        # the larger impact wins, then the earlier place
        self.table = range_maxima(impacts << _BITS | (SHARD_DOCS - 1 - self.docs), longest)
        self.least_id = -range_maxima(-self.ids, n)

    def _bounds(self, ranks, times, lo, hi):
        """Of intervals [lo, hi): the summed maxima, the document of the largest one, the least id."""
        first, last = ranks[:, lo], ranks[:, hi]
        log = _LOG[last - first]
        table, width = self.table.ravel(), self.table.shape[1]
        some = last > first
        left = np.where(some, log * width + first, 0)
        right = np.where(some, log * width + last - (1 << log), 0)
        key = np.where(some, np.maximum(table[left], table[right]), 0)
        worth = (key >> _BITS) * times
        top = worth.argmax(axis=0)
        split = SHARD_DOCS - 1 - (key[top, np.arange(len(lo))] & (SHARD_DOCS - 1))
        log = _LOG[hi - lo]
        least = np.minimum(self.least_id[log, lo], self.least_id[log, hi - (1 << log)])
        return worth.sum(axis=0), split, least

    def search(self, query: np.ndarray, times: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]):
        """The k best of ``best`` (scores, ids) and this shard, best first."""
        at = np.searchsorted(self.terms, query)
        at[at == len(self.terms)] = 0
        known = self.terms[at] == query if len(self.terms) else np.zeros(len(query), bool)
        if not known.any():
            return best
        at, times = at[known], times[known][:, None]
        ranks = np.zeros((len(at), self.n + 1), np.int64)       # postings before each place, from the list's start
        for row, i, j in zip(ranks, self.starts[at], self.ends[at]):
            row[self.docs[i:j] + 1] = 1
            row[0] = i
        np.cumsum(ranks, axis=1, out=ranks)
        lo, hi = np.array([0]), np.array([self.n])
        bound, split, least = self._bounds(ranks, times, lo, hi)
        flat, size = self.table[0], 8
        while True:
            scores, ids = best
            kth, kth_id = (scores[-1], ids[-1]) if len(scores) == k else (1, NO_ID)
            alive = (bound > kth) | (bound == kth) & (least <= kth_id)
            lo, hi, bound, split, least = (x[alive] for x in (lo, hi, bound, split, least))
            if not len(lo):
                return best
            if len(lo) > size:
                order = np.argpartition(-bound, size - 1)
            else:
                order = np.arange(len(lo))
            now, later = order[:size], order[size:]
            size = min(2 * size, BATCH)
            docs = split[now]
            first, has = ranks[:, docs], ranks[:, docs + 1] > ranks[:, docs]
            found = (np.where(has, flat[np.where(has, first, 0)] >> _BITS, 0) * times).sum(axis=0)
            scores, ids = np.concatenate([scores, found]), np.concatenate([ids, self.ids[docs]])
            top = np.lexsort((ids, -scores))[:k]
            best = scores[top], ids[top]
            new_lo, new_hi = np.concatenate([lo[now], docs + 1]), np.concatenate([docs, hi[now]])
            some = new_hi > new_lo
            new_lo, new_hi = new_lo[some], new_hi[some]
            made = self._bounds(ranks, times, new_lo, new_hi)
            lo, hi = np.concatenate([lo[later], new_lo]), np.concatenate([hi[later], new_hi])
            bound, split, least = (np.concatenate([x[later], y]) for x, y in zip((bound, split, least), made))


def corpus_counts(src: DataFrame, vocabulary: dict[bytes, int]) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and the document frequency of each of ``vocabulary``."""
    def count(batches):
        df, docs, total = np.zeros(len(vocabulary), np.int64), 0, 0
        known = vocabulary.keys()
        for b in batches:
            for text in _texts(b):
                words = terms(text)
                docs, total = docs + bool(words), total + len(words)
                for w in known & set(words):
                    df[vocabulary[w]] += 1
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-2, -1, *held]), pa.array([docs, total, *df[held]])], names=["term", "n"])

    out = np.zeros(len(vocabulary) + 2, np.int64)
    for r in src.mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r.term + 2] = r.n
    return int(out[0]), int(out[1]), out[2:]


def _block(src: DataFrame, queries: list[tuple], k: int, item_type) -> DataFrame:
    """``item, query, doc_id, score``: each task's k best documents of every query of a block."""
    kind = to_arrow_type(item_type)
    lists, vocabulary = [], {}
    for _, text in queries:
        times = {}
        for w in terms((text or "").encode("utf-8", "replace")):
            t = vocabulary.setdefault(w, len(vocabulary))
            times[t] = times.get(t, 0) + 1
        lists.append((np.array(sorted(times), np.int64), np.array([times[t] for t in sorted(times)], np.int64)))
    n_docs, n_terms, df = corpus_counts(src, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    items = [i for i, _ in queries]

    def shards(batches):
        ids, docs, held, norms, n = [], [], [], [], 0
        get = vocabulary.get

        def close():
            key, tf = np.unique(np.array(held, np.int64) * SHARD_DOCS + np.repeat(np.arange(len(ids)), docs), return_counts=True)
            t, d = key >> _BITS, key & (SHARD_DOCS - 1)
            m = np.array(norms, np.int64)[d]
            return Shard(np.array(ids, np.int64), d, t, weight[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m)))

        for b in batches:
            for i, text in zip(b.column("doc_id").to_pylist(), _texts(b)):
                words = terms(text)
                found = [t for t in map(get, words) if t is not None]
                if not found:
                    continue
                ids.append(NO_ID if i is None else i)
                docs.append(len(found))
                held += found
                norms.append(25 + 75 * len(words) * n_docs // n_terms)
                n += len(set(found))
                if len(ids) == SHARD_DOCS or n >= SHARD_POSTINGS:
                    yield close()
                    ids, docs, held, norms, n = [], [], [], [], 0
        if ids:
            yield close()

    def search(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(lists)
        for shard in shards(batches):
            best = [shard.search(q, times, k, b) for (q, times), b in zip(lists, best)]
        for i, (scores, ids) in enumerate(best):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([items[i]] * len(scores), kind), pa.array([i] * len(scores), pa.int32()),
                     pa.array([None if x == NO_ID else x for x in ids.tolist()], pa.int64()), pa.array(scores)],
                    names=["item", "query", "doc_id", "score"])

    return src.mapInArrow(search, f"item {item_type.simpleString()}, query int, doc_id long, score long")


def ranked(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The ``k`` best documents of every query: ``item, rank, doc_id, score``.

    A term's weight falls with its document frequency, its impact in a document
    rises with its occurrences and falls with the document's length (integers,
    see the formulas in ``_block``); a score sums the impacts of the query's
    terms, repeats included. Only scores above 0 count; equal scores by
    ascending id, null ids last. Ids must be integers.

    Null, empty or term-less texts are no documents and no queries: the former
    count nowhere, the latter have no rows. Repeated documents are documents of
    their own; equal query rows are one query, different texts under one item
    are queries of their own. Other columns are ignored, whatever their names;
    without documents or queries there are no rows.
    """
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{id_col} must be an integer column")
    spark = docs.sparkSession
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    asked = queries.select(queries[item_col].alias("item"), queries[item_text_col].cast("string").alias("text"))
    asked = asked.where("text IS NOT NULL").distinct()
    volume = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-volume // BLOCK_BYTES)
    item_type, parts = asked.schema["item"].dataType, []
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        if rows:
            found = _block(src, [(r.item, r.text) for r in rows], k, item_type)
            parts.append(found.withColumn("block", F.lit(block)))
    if not parts:
        return spark.createDataFrame([], f"item {item_type.simpleString()}, rank int, doc_id long, score long")
    best = parts[0]
    for more in parts[1:]:
        best = best.unionByName(more)
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item", "rank", "doc_id", "score")
