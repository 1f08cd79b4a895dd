"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance ``r`` or less have a common point within ``r / 2``
(rounded up and down) of each. Every distinct fingerprint therefore emits all
variants within half the radius; fingerprints that share a variant collide.

The variants travel as sorted 32-bit keys beside a bucket number, in compact
blobs: the first pass only learns which keys two fingerprints share (one bit
per key comes back). The second pass emits the shared variants in full, so a
chance match of short keys drops out, and verifies each pair's distance. Two
fingerprints that truly share a variant are linked by the triangle inequality,
so each links to the smallest of its variant's group: a group of copies gives
one link per member, never all pairs, and no link is lost. Copies of one
fingerprint are one entry from the start. A variant has at most as many
members as a ball has points, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .columns import sliced, unused
from .components import components
from .packed import (binary, bucket_bits, bucket_edges, pack_bits, pack_keys, parallelism,
                     unpack_bits, unpack_keys)
from .words import mix

SLICE = 1024          # fingerprints expanded at a time: about 17 MB of variants
STRIP = 64            # of these, hashed at a time: about 1 MB
MIN_BITS = 6          # of a key's bucket: a slice's keys of one bucket are at most about 130 kB
_BITS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """64-bit SimHash of a UTF-8 text: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``,
    shingles of ``shingle`` words joined by a space (fewer words: all of them),
    XXH64; a bit is set if it is in over half of the hashes. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], seed) for i, j in
                       zip(begins[:len(words) - width + 1].tolist(), ends[width - 1:].tolist())], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i:i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(_BITS[2 * ones > len(hashes)].sum())


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_hash, fp`` per row; ``fp`` is the fingerprint as a signed
    long, ``text_hash`` tells rows of one id apart. Null text counts as empty."""
    src = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    src = src.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")

    def run(batches):
        for b in sliced(batches):
            got = [fingerprint(x or b"", shingle) for x in b.column("text").cast(pa.binary()).to_pylist()]
            fp = pa.array(np.array(got, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), fp],
                                             names=["doc_id", "text_hash", "fp"])

    kind = src.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def _masks(radius: int) -> np.ndarray:
    """XOR masks of all variants within ``radius`` bits, the identity first."""
    sets = [s for k in range(radius + 1) for s in combinations(range(64), k)]
    return np.array([sum(1 << i for i in s) for s in sets], np.uint64)


def _joining(pairs: np.ndarray) -> np.ndarray:
    """Those of the pairs that join two parts not yet connected by earlier ones:
    fewer than there are members, however densely these are linked."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    keep = np.zeros(len(pairs), bool)
    for i, (u, v) in enumerate(pairs.tolist()):
        a, b = find(u), find(v)
        if a != b:
            parent[a] = b
            keep[i] = True
    return pairs[keep]


def links(fps: DataFrame, distance: int = 4) -> DataFrame:
    """Links ``(u, v)`` between distinct fingerprints (column ``fp``, no nulls)
    at ``distance`` or fewer differing bits: enough of them to connect exactly
    the fingerprints that all such pairs connect, each verified."""
    spark = fps.sparkSession
    coarse, chunks = bucket_bits(spark), 2 * parallelism(spark)
    bits = max(coarse, MIN_BITS)
    masks = _masks((distance + 1) // 2)
    src = fps.select("fp", F.pmod(F.xxhash64("fp"), F.lit(chunks)).alias("chunk"))
    # dealt by number, not by size: a fingerprint is a few bytes here and thousands of variants in its task
    src = src.repartition(chunks, "chunk")

    def slices(table):
        fp = np.sort(table["fp"].to_numpy().view(np.uint64))
        for i in range(0, len(fp), SLICE):
            yield i // SLICE, fp[i:i + SLICE]

    def expand(fp):
        """Distinct keys of all variants, and whether two fingerprints here share one."""
        keys = np.empty((len(fp), len(masks)), np.uint64)
        for i in range(0, len(fp), STRIP):
            np.bitwise_xor(fp[i:i + STRIP, None], masks[None, :], out=keys[i:i + STRIP])
            mix(keys[i:i + STRIP], in_place=True)
        keys = keys.ravel()
        keys >>= np.uint64(32 - bits)
        keys.sort()
        again = np.append(keys[1:] == keys[:-1], False)       # the next one is equal
        first = np.append(True, ~again[:-1])
        return keys[first], again[first]

    def key_edges(keys):
        """Where each bucket begins in the sorted keys."""
        return np.searchsorted(keys, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(32))

    def send(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, fp in slices(pa.Table.from_batches(list(batches))):
            keys, _ = expand(fp)
            edges = key_edges(keys)
            out = [(b, pack_keys(keys[i:j].astype(np.uint32)))
                   for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
            del keys
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int32()), pa.array([key[0].as_py()] * len(out), pa.int64()),
                 pa.array([part] * len(out), pa.int32()), binary([o[1] for o in out])],
                names=["bucket", "chunk", "part", "keys"])

    def answer(key, table):
        # the blobs are unpacked twice, so that the keys are held once beside them
        blobs = [x.as_buffer() for x in table["keys"]]
        ends = np.cumsum([0] + [len(x) // 4 for x in blobs])
        both = np.empty(ends[-1], np.uint32)
        for blob, i, j in zip(blobs, ends[:-1], ends[1:]):
            both[i:j] = unpack_keys(blob)
        both.sort()
        shared = np.unique(both[1:][both[1:] == both[:-1]])
        del both
        some, hits = [], []
        for i, blob in enumerate(blobs):
            if len(shared):
                own = unpack_keys(blob)
                at = np.searchsorted(shared, own)
                at[at == len(shared)] = 0
                hit = shared[at] == own
                if hit.any():
                    some.append(i)
                    hits.append(pack_bits(hit))
        take = pa.array(some, pa.int64())
        return pa.table({"chunk": table["chunk"].combine_chunks().take(take),
                         "part": table["part"].combine_chunks().take(take),
                         "bucket": pa.array([key[0].as_py()] * len(some), pa.int32()), "hits": binary(hits)})

    def send_shared(key, left, right):
        """(variant, fingerprint) of every shared variant, one blob per bucket."""
        answers: dict[int, dict[int, bytes]] = {}
        for part, b, blob in zip(right["part"].to_pylist(), right["bucket"].to_pylist(), right["hits"].to_pylist()):
            answers.setdefault(part, {})[b] = blob
        points, owners = [], []
        for part, fp in slices(left):
            keys, hit = expand(fp)
            edges = key_edges(keys)
            for b, blob in answers.get(part, {}).items():
                hit[edges[b]:edges[b + 1]] |= unpack_bits(blob, edges[b + 1] - edges[b])
            found = keys[hit]
            if not len(found):
                continue
            del keys, hit
            for i in range(0, len(fp), STRIP):
                some = fp[i:i + STRIP]
                p = (some[:, None] ^ masks[None, :])
                k = mix(p) >> np.uint64(32 - bits)
                at = np.searchsorted(found, k)
                at[at == len(found)] = 0
                row, col = np.nonzero(found[at] == k)
                points.append(p[row, col])
                owners.append(some[row])
        p = np.concatenate(points or [np.zeros(0, np.uint64)])
        o = np.concatenate(owners or [np.zeros(0, np.uint64)])
        bucket = mix(p) >> np.uint64(64 - coarse)
        order = np.argsort(bucket, kind="stable")
        p, o = p[order], o[order]
        edges = bucket_edges(bucket[order], coarse)
        got = [(b, p[i:j].tobytes(), o[i:j].tobytes()) for b, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        return pa.table({"bucket": pa.array([g[0] for g in got], pa.int32()),
                         "points": binary([g[1] for g in got]), "owners": binary([g[2] for g in got])})

    def link(key, table):
        p = np.concatenate([np.frombuffer(x, np.uint64) for x in table["points"].to_pylist()])
        o = np.concatenate([np.frombuffer(x, np.uint64) for x in table["owners"].to_pylist()])
        # Two fingerprints within an odd distance 2r + 1 share a variant within r of the one and r + 1 of the other,
        # so a group is linked to its smallest member within r, and a group without one to none.
        far = np.bitwise_count(o ^ p) > distance // 2
        order = np.lexsort((o, far, p))
        p, o, far = p[order], o[order], far[order]
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        size = np.diff(first, append=len(p))
        head, led = np.repeat(o[first], size), np.repeat(~far[first], size)
        pairs = np.unique(np.stack([o, head], 1)[led & (o != head)], axis=0)
        near = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= distance
        pairs = _joining(pairs[near]).view(np.int64)
        return pa.table({"u": pa.array(pairs[:, 0]), "v": pa.array(pairs[:, 1])})

    answers = (src.groupBy("chunk").applyInArrow(send, "bucket int, chunk long, part int, keys binary")
               .groupBy("bucket").applyInArrow(answer, "chunk long, part int, bucket int, hits binary"))
    return (src.groupBy("chunk").cogroup(answers.groupBy("chunk"))
            .applyInArrow(send_shared, "bucket int, points binary, owners binary")
            .groupBy("bucket").applyInArrow(link, "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` (16 hex digits),
    ``component_id`` (the smallest id reachable over links of ``distance`` or
    fewer differing bits, itself included), ``component`` (a long naming the
    component whatever its ids) and ``text_hash``.

    Null or empty text, or text of separators only, has fingerprint zero and
    links like any other. Rows of one id are separate rows. A null id is never
    the smallest unless all ids of its component are null. Other columns are
    ignored, whatever their names. An empty table gives no rows.
    """
    prints = staged(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    each = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    each = staged(each, "distinct")
    roots = components(links(each, distance))
    each = each.join(roots, each.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("component"))
    least = each.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = each.join(least, "component").select("fp", "component", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "component", "text_hash")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: that of its smallest id (null
    last), among rows of that id the one of the smallest text hash; rows equal
    in both are copies, and one of them stays."""
    found = near_duplicates(docs, shingle, distance, id_col, text_col)
    keep_id, keep_hash, own_hash = unused(docs, "keep_id", "keep_hash", "own_hash")
    chosen = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("one")
    keepers = found.groupBy("component").agg(chosen).select(
        F.col("one.doc_id").alias(keep_id), F.col("one.text_hash").alias(keep_hash)).distinct()
    own = docs.withColumn(own_hash, F.xxhash64(docs[text_col].cast("string")))
    same = own[id_col].eqNullSafe(keepers[keep_id]) & (own[own_hash] == keepers[keep_hash])
    return own.join(keepers, same, "left_semi").dropDuplicates([id_col, own_hash]).drop(own_hash)
