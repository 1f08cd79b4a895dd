"""Exact top-k search by inner product with one KD-tree per shard.

Vectors are dealt into shards by hash. Each shard builds a KD-tree (median
splits on the widest dimension, tight bounding boxes) and stores it as one
row. Queries meet the shards block by block: a (shard, query block) pair is
one group, with one tree and one bounded block of queries. A query walks a
tree best first, by the bound ``sum(max(q*lo, q*hi))`` of a box, and stops
when no box can reach its kth score.

The kth score is propagated: every query first searches one shard, and the kth
score found there is its floor in all others, so most of their boxes are never
opened. The k best of all shards are then merged per query, with a partial
limit per task.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import staged
from .packed import parallelism

LEAF = 64                 # vectors of a leaf; a box of equal vectors is not split further
QUERY_BLOCK = 512         # queries of one group, about
_LONG = 2**63 - 1


class Tree:
    """A KD-tree over integer vectors; nodes in arrays, children after parents."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order, nodes = np.arange(len(ids)), []
        todo = [(0, len(ids))]
        while todo:
            i, j = todo.pop()
            own = vectors[order[i:j]]
            lo, hi = own.min(0), own.max(0)
            node = [i, j, -1, -1, lo, hi]
            nodes.append(node)
            wide = int(np.argmax(hi - lo))
            if j - i <= LEAF or hi[wide] == lo[wide]:
                continue
            mid = (j - i) // 2
            order[i:j] = order[i:j][np.argpartition(own[:, wide], mid, kind="introselect")]
            todo += [(i, i + mid), (i + mid, j)]
            node[2] = 1        # children are found by their ranges below
            node[3] = i + mid
        at = {(n[0], n[1]): k for k, n in enumerate(nodes)}
        self.first = np.array([n[0] for n in nodes], np.int64)
        self.last = np.array([n[1] for n in nodes], np.int64)
        self.left = np.array([at[n[0], n[3]] if n[2] > 0 else -1 for n in nodes], np.int64)
        self.right = np.array([at[n[3], n[1]] if n[2] > 0 else -1 for n in nodes], np.int64)
        self.lo = np.array([n[4] for n in nodes])
        self.hi = np.array([n[5] for n in nodes])
        self.ids, self.vectors = ids[order], vectors[order]

    ARRAYS = ("first", "last", "left", "right", "lo", "hi", "ids", "vectors")

    def dump(self) -> dict[str, bytes]:
        return {n: getattr(self, n).astype("<i8").tobytes() for n in self.ARRAYS}

    @classmethod
    def load(cls, row: dict, dim: int) -> Tree:
        tree = cls.__new__(cls)
        for n in cls.ARRAYS:
            a = np.frombuffer(row[n], "<i8")
            setattr(tree, n, a.reshape(-1, dim) if n in ("lo", "hi", "vectors") else a)
        tree.exact = lambda q: _exact_kind(q, tree.lo, tree.hi)
        return tree

    def search(self, own_id: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The ``k`` best ``(score, id)`` of vectors not called ``own_id``, by score
        and then smaller id; those below ``floor`` need not be found."""
        kind = self.exact(query)
        q, lo, hi = (a.astype(kind) for a in (query, self.lo, self.hi))
        bounds = np.maximum(q * lo, q * hi).sum(1)
        best: list[tuple[int, int]] = []          # a heap of (score, -id), the worst on top
        todo = [(-bounds[0], 0)]
        while todo:
            bound, at = heapq.heappop(todo)
            least = best[0][0] if len(best) == k else floor
            if least is not None and -bound < least:
                break
            if self.left[at] >= 0:
                for child in (self.left[at], self.right[at]):
                    heapq.heappush(todo, (-bounds[child], int(child)))
                continue
            i, j = self.first[at], self.last[at]
            scores = self.vectors[i:j].astype(kind) @ q
            if kind is object:
                scores = np.clip(scores, -_LONG, _LONG)
            reach = np.ones(j - i, bool) if least is None else scores >= least
            reach &= self.ids[i:j] != own_id
            found = np.flatnonzero(reach)
            if len(found) > k:                    # only this leaf's k best can matter
                found = found[np.lexsort((self.ids[i:j][found], -scores[found]))[:k]]
            for x in found:
                item = (int(scores[x]), -int(self.ids[i + x]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _exact_kind(q: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """A number type in which all inner products are exact: doubles below 2^53,
    else Python integers."""
    far = max(abs(int(lo.min())), abs(int(hi.max()))) * max(abs(int(q.min())), abs(int(q.max()))) * len(q)
    return float if far < 2**53 else object


def _integers(values) -> np.ndarray:
    """floor(256 * x) of each component, kept within a long."""
    scaled = np.floor(256.0 * np.array(values, float))
    return np.array([min(max(int(v), -_LONG), _LONG) for v in scaled], "<i8") if np.abs(scaled).max() > 2**62 else scaled.astype("<i8")


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, dim, v`` (floor(256 x) as packed longs) of rows with an id and a
    non-empty vector of finite, non-null components; rows equal in both count once."""
    v = F.transform(table[vector_col], lambda x: x.cast("double"))
    src = table.select(table[id_col].cast("long").alias("id"), v.alias("v"))
    ok = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    src = src.where(F.col("id").isNotNull() & (F.size("v") > 0) & ok)

    def run(batches):
        for b in batches:
            got = [_integers(x) for x in b.column("v").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([len(g) for g in got], pa.int32()), pa.array([g.tobytes() for g in got], pa.binary())],
                names=["id", "dim", "v"])

    return src.mapInArrow(run, "id long, dim int, v binary").distinct()


def top_k(table: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          shards: int | None = None) -> DataFrame:
    """The ``k`` highest inner products of every query with every other vector.

    ``is_query`` is a condition on the column ``id``. Returns ``query_id, rank``
    (from 1), ``vec_id, score``; ties go to the smaller id, and a query with
    fewer candidates gets all of them. Rows whose id or vector is null, or whose
    vector is empty or holds null or non-finite components, take no part; rows
    equal in id and vector are one; rows that share the query's id are its own, and
    an id with several vectors gets the best over all of them.
    Vectors meet only queries of their length. Scaled components and scores
    beyond a long are cut to its range before they are ranked. Other columns are ignored, whatever their names; an empty table
    gives no rows.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    spark = table.sparkSession
    shards = shards or parallelism(spark)
    vectors = staged(valid_vectors(table, id_col, vector_col), "vectors")
    placed = vectors.withColumn("shard", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int"))

    def build(key, rows):
        tree = Tree(rows["id"].to_numpy().astype("<i8"),
                    np.frombuffer(b"".join(rows["v"].to_pylist()), "<i8").reshape(rows.num_rows, -1))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "shard": pa.array([key[1].as_py()], pa.int32()),
                         **{n: pa.array([x], pa.binary()) for n, x in tree.dump().items()}})

    columns = ", ".join(f"{n} binary" for n in Tree.ARRAYS)
    trees = staged(placed.groupBy("dim", "shard").applyInArrow(build, f"dim int, shard int, {columns}"), "trees")
    queries = vectors.where(is_query)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(blocks)).cast("int"))

    def walk(key, left, right):
        dim = key[0].as_py()
        out = ([], [], [])
        tree = Tree.load({n: left[n][0].as_py() for n in Tree.ARRAYS}, dim) if left.num_rows else None
        if tree is not None:
            for i, v, floor in zip(right["id"].to_pylist(), right["v"].to_pylist(), right["floor"].to_pylist()):
                for score, found in tree.search(i, np.frombuffer(v, "<i8"), k, floor):
                    out[0].append(i)
                    out[1].append(found)
                    out[2].append(score)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.int64())})

    def meet(asked: DataFrame) -> DataFrame:
        """All trees with the queries ``asked(id, v, dim, shard, block, floor)`` for them."""
        keys = ["dim", "shard", "block"]
        wanted = asked.select(*keys).distinct()
        sent = trees.join(wanted, ["dim", "shard"])
        sent = sent.select(*(F.col(c).alias(f"tree_{c}") for c in keys), *Tree.ARRAYS)   # names of its own
        return (sent.groupBy(*(f"tree_{c}" for c in keys)).cogroup(asked.groupBy(*keys))
                .applyInArrow(walk, "query_id long, vec_id long, score long"))

    def best(found: DataFrame) -> DataFrame:
        rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return found.withColumn("rank", rank).where(F.col("rank") <= k)

    home = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(shards)).cast("int")
    asked = queries.withColumns({"shard": home, "floor": F.lit(None).cast("long")})
    first = staged(best(meet(asked)), "first")
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("floor"))
    floors = floors.where(F.col("n") == k).select(F.col("query_id").alias("id"), "floor")
    others = (queries.withColumn("home", home).join(floors, "id", "left")
              .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home").drop("home"))
    rest = meet(others.select("id", "dim", "v", "block", "shard", "floor"))
    return (best(first.select("query_id", "vec_id", "score").unionByName(rest))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
