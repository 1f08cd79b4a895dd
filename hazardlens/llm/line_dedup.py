"""Line dedup: lines that many documents hold stay in one of them.

A line's key is the line without surrounding white space, A-Z lower-cased; its
hash has 64 bits for its place and 32 for its fingerprint. The distinct hashes
of all lines are dealt to shards by their upper bits. Each shard builds a
minimal perfect hash over its own (levels of bit arrays, a key on the first
level where it meets no other) that indexes a fingerprint array, a count array
(documents that hold the line) and, for counts at the threshold, the largest
document id. Documents then probe the arrays, a chunk's distinct hashes at a
time as one packed row per shard; no row is made per line and no lines are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .chunks import chunked, pack_table, unpack_table
from .packed import binary, pack_bits, pack_hashes, parallelism, unpack_bits, unpack_hashes
from .words import mix

SPACE = b"\x20\t\n\x0b\x0c\r"
NULL_ID = -(1 << 63)          # a null id counts as the smallest
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_HASH = np.dtype([("place", "<u8"), ("print", "<u4")])


class PerfectHash:
    """Minimal perfect hash over distinct (place, fingerprint) pairs.

    Level ``l`` has two bits per key that is left; a key whose bit no other key
    of that level shares is placed there, the others go on. A key's number is
    the rank of its bit over all levels.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        total = np.cumsum([0, *(int(x.sum()) for x in levels)])
        self.ranks = [np.cumsum(x, dtype=np.int64) - 1 + n for x, n in zip(levels, total)]
        self.n = int(total[-1])

    @staticmethod
    def _place(places: np.ndarray, prints: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            salt = mix((prints.astype(np.uint64) + np.uint64(level + 1)) * _GOLDEN)
        return (mix(places ^ salt) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, places: np.ndarray, prints: np.ndarray) -> PerfectHash:
        levels = []
        while len(places):
            size = max(64, 2 * len(places))
            at = cls._place(places, prints, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone)
            again = ~alone[at]
            places, prints = places[again], prints[again]
        return cls(levels)

    def lookup(self, places: np.ndarray, prints: np.ndarray) -> np.ndarray:
        """The number of each key; of a key that was not built in, some number or -1."""
        out = np.full(len(places), -1, np.int64)
        left = np.arange(len(places))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            at = self._place(places[left], prints[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = ranks[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        return out

    def to_bytes(self) -> list[bytes]:
        return [len(x).to_bytes(8, "little") + pack_bits(x) for x in self.levels]

    @classmethod
    def from_bytes(cls, blobs: list[bytes]) -> PerfectHash:
        return cls([unpack_bits(x[8:], int.from_bytes(x[:8], "little")) for x in blobs])


def digests(text: bytes, min_chars: int) -> tuple[list[bytes], list[bytes | None]]:
    """The lines of a text and, for keys of at least ``min_chars`` code points, the key's hash."""
    lines, hashes = text.split(b"\n"), []
    for line in lines:
        key = line.strip(SPACE)
        long = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)
        hashes.append(xxhash.xxh3_128_digest(key.lower())[:12] if long else None)
    return lines, hashes


def _parts(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints of 12-byte hashes."""
    both = np.frombuffer(raw, _HASH)
    return both["place"].copy(), both["print"].copy()


def _shards(places: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each place; rises with it."""
    return ((places >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _merge(places, prints, counts, ids):
    """Per distinct key, in order: summed counts and the largest id."""
    order = np.lexsort((ids, prints, places))
    places, prints, counts, ids = places[order], prints[order], counts[order], ids[order]
    new = np.ones(len(places), bool)
    new[1:] = (places[1:] != places[:-1]) | (prints[1:] != prints[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(places))[:len(first)] - 1
    return places[first], prints[first], np.add.reduceat(counts, first) if len(first) else counts, ids[last]


def _texts(blob: bytes) -> tuple[pa.ChunkedArray, list[int], list[bytes]]:
    table = unpack_table(blob)
    ids = [NULL_ID if x is None else x for x in table["doc_id"].to_pylist()]
    return table["doc_id"], ids, [x or b"" for x in table["text"].cast(pa.binary()).to_pylist()]


_SENT = "shard int, chunk long, n long, places binary, prints binary, counts binary, ids binary"
_INDEX = "shard int, n long, levels array<binary>, fingerprints binary, counts binary, keepers binary"


def _chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    if docs.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"{id_col} must be an integer column, since the largest one keeps a line")
    src = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return chunked(src, "docs binary")


def _line_hashes(chunks: DataFrame, min_chars: int, shards: int) -> DataFrame:
    """Per chunk and shard: the distinct keys, sorted and packed, with the number
    of documents that hold each and the largest of their ids."""
    def send(key, table):
        _, ids, texts = _texts(table["docs"][0].as_py())
        found = [{h for h in digests(t, min_chars)[1] if h} for t in texts]
        places, prints = _parts(b"".join(h for some in found for h in some))
        each = np.repeat(np.array(ids, np.int64), [len(x) for x in found])
        places, prints, counts, ids = _merge(places, prints, np.ones(len(places), np.int64), each)
        edges = np.searchsorted(_shards(places, shards), np.arange(shards + 1))
        spans = [(s, i, j) for s, (i, j) in enumerate(zip(edges[:-1], edges[1:])) if j > i]
        return pa.table({"shard": pa.array([s for s, _, _ in spans], pa.int32()),
                         "chunk": pa.array([key[0].as_py()] * len(spans), pa.int64()),
                         "n": pa.array([j - i for _, i, j in spans], pa.int64()),
                         "places": binary([pack_hashes(places[i:j]) for _, i, j in spans]),
                         "prints": binary([prints[i:j].tobytes() for _, i, j in spans]),
                         "counts": binary([counts[i:j].astype("<u4").tobytes() for _, i, j in spans]),
                         "ids": binary([ids[i:j].tobytes() for _, i, j in spans])})

    return chunks.groupBy("chunk").applyInArrow(send, _SENT)


def _column(table: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _index(sent: DataFrame, min_docs: int) -> DataFrame:
    def build(key, table):
        places = np.concatenate([unpack_hashes(x) for x in table["places"].to_pylist()])
        places, prints, counts, ids = _merge(places, _column(table, "prints", "<u4"),
                                             _column(table, "counts", "<u4").astype(np.int64), _column(table, "ids", "<i8"))
        hashed = PerfectHash.build(places, prints)
        order = np.argsort(hashed.lookup(places, prints))
        counts = counts[order]
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "n": pa.array([hashed.n], pa.int64()),
                         "levels": pa.array([hashed.to_bytes()], pa.list_(pa.binary())),
                         "fingerprints": binary([prints[order].tobytes()]),
                         "counts": binary([np.minimum(counts, 2**32 - 1).astype("<u4").tobytes()]),
                         "keepers": binary([ids[order][counts >= min_docs].tobytes()])})

    return sent.groupBy("shard").applyInArrow(build, _INDEX)


def line_index(docs: DataFrame, min_chars: int = 40, min_docs: int = 5, shards: int | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sharded index of all lines of ``docs`` with ``min_chars`` code points:
    one row per shard with ``levels`` (of the perfect hash), ``fingerprints``,
    ``counts`` and ``keepers`` (largest ids, in order, of the lines that at
    least ``min_docs`` documents hold). A shard without lines has no row."""
    shards = shards or parallelism(docs.sparkSession)
    return _index(_line_hashes(_chunks(docs, id_col, text_col), min_chars, shards), min_docs)


def drop_repeated_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept_text``.

    A line whose key has at least ``min_chars`` code points and stands in at
    least ``min_docs`` documents (rows) goes, except in the documents with the
    largest id that holds it. Lines are parted by ``\\n`` and stay as they are.

    Null or empty text is one empty line. A null id counts as smaller than any
    other; rows that share the largest id keep their lines, and repeated rows
    are documents of their own. Ids must be integers. Other columns are
    ignored, whatever their names; an empty table gives no rows.
    """
    shards = parallelism(docs.sparkSession)
    chunks = _chunks(docs, id_col, text_col)
    sent = _line_hashes(chunks, min_chars, shards)

    def probe(key, left, right):
        """For each chunk, those of its keys that are repeated and who keeps them."""
        one = right.slice(0, 1).to_pylist()[0]
        hashed = PerfectHash.from_bytes(one["levels"])
        prints, counts = np.frombuffer(one["fingerprints"], "<u4"), np.frombuffer(one["counts"], "<u4")
        keepers, repeated = np.frombuffer(one["keepers"], "<i8"), counts >= min_docs
        keeper_at = np.cumsum(repeated) - 1
        gone = []
        for places, own in zip(left["places"].to_pylist(), left["prints"].to_pylist()):
            places, own = unpack_hashes(places), np.frombuffer(own, "<u4")
            at = hashed.lookup(places, own)
            hit = (at >= 0) & (prints[at] == own) & repeated[at]
            both = np.empty(int(hit.sum()), _HASH)
            both["place"], both["print"] = places[hit], own[hit]
            hashes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(12), len(both), [None, pa.py_buffer(both.tobytes())])
            gone.append(pack_table(pa.table({"hash": hashes, "keeper": pa.array(keepers[keeper_at[at[hit]]])})))
        return pa.table({"chunk": left["chunk"], "gone": binary(gone)})

    answers = sent.groupBy("shard").cogroup(_index(sent, min_docs).groupBy("shard")).applyInArrow(
        probe, "chunk long, gone binary")

    def finish(key, left, right):
        gone = {}
        for blob in right["gone"].to_pylist():
            some = unpack_table(blob)
            gone.update(zip(some["hash"].to_pylist(), some["keeper"].to_pylist()))
        column, ids, texts = _texts(left["docs"][0].as_py())
        rows = []
        for own, text in zip(ids, texts):
            lines, hashes = digests(text, min_chars)
            stay = [x for x, h in zip(lines, hashes) if h is None or gone.get(h, own) == own]
            rows.append((len(lines), len(lines) - len(stay), b"\n".join(stay)))
        n, dropped, kept = zip(*rows)
        return pa.table([column, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()),
                         pa.array(kept, pa.binary()).cast(pa.string())],
                        names=["doc_id", "n_lines", "n_dropped", "kept_text"])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, n_lines long, n_dropped long, kept_text string")
