import random
import tracemalloc
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from hazardlens.llm import simhash as H
from hazardlens.llm.columns import sliced
from hazardlens.llm.components import components
from hazardlens.llm.packed import bucket_bits

from . import brute, data


def test_odd_rows_match_brute_force(spark):
    rows = data.odd_rows()
    got = sorted((r.doc_id or -1, r.fingerprint, r.component_id or -1) for r in H.near_duplicates(data.frame(spark, rows)).collect())
    items = [(i, brute.simhash(t)) for i, t, *_ in rows]
    roots = brute.roots(items, lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    assert got == sorted((i or -1, f"{f:016x}", c or -1) for (i, f), c in zip(items, roots))


@pytest.mark.parametrize("distance", [1, 2, 3, 4])
def test_links_connect_exactly_the_near_ones(spark, distance):
    """Planted neighbours at every distance from 0 to 6 bits, chains, and a dense ball."""
    rng = random.Random(distance)
    fps = set()
    for _ in range(60):
        f = rng.getrandbits(64)
        fps.add(f)
        for bits in range(1, 7):
            f ^= sum(1 << b for b in rng.sample(range(64), bits))
            fps.add(f)
    core = rng.getrandbits(64)
    fps |= {core ^ (1 << a) ^ (1 << b) for a in range(24) for b in range(a)}
    fps = sorted(fps)
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    links = H.links(spark.createDataFrame(signed, "fp long"), distance)
    pairs = [(r.u % 2**64, r.v % 2**64) for r in links.collect()]
    assert all((u ^ v).bit_count() <= distance for u, v in pairs)
    buckets = 1 << bucket_bits(spark)
    assert len(pairs) < buckets * len(fps)                # a dense ball gives no all-pairs
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in pairs:
        parent[find(u)] = find(v)
    items = [(f, f) for f in fps]
    want = brute.roots(items, lambda a, b: (a[1] ^ b[1]).bit_count() <= distance)
    groups = {}
    for f, w in zip(fps, want):
        groups.setdefault(w, set()).add(find(f))
    assert all(len(g) == 1 for g in groups.values()) and len({x for g in groups.values() for x in g}) == len(groups)


@pytest.mark.parametrize("distance", [1, 3])
def test_odd_distances_lose_no_link(spark, distance):
    """The chain 32, 33, 97, 65 by single bits, and many small dense sets that share variants."""
    rng = random.Random(distance)
    sets = [{32, 65, 96, 97}] + [{rng.getrandbits(distance + 4) for _ in range(9)} for _ in range(40)]
    fps = sorted({(k << 40) * 0x10001 % 2**63 ^ f for k, some in enumerate(sets) for f in some})
    links = H.links(spark.createDataFrame([(f,) for f in fps], "fp long"), distance)
    parent = {f: f for f in fps}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for r in links.collect():
        assert (r.u ^ r.v).bit_count() <= distance
        parent[find(r.u)] = find(r.v)
    want = brute.roots([(f, f) for f in fps], lambda a, b: (a[1] ^ b[1]).bit_count() <= distance)
    assert len({(find(f), w) for f, w in zip(fps, want)}) == len(set(want)) == len({find(f) for f in fps})


def test_fingerprint_is_sparks_xxhash64(spark):
    text = "one two three four"
    want = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] % 2**64
    assert H.fingerprint(b"One  TWO\tthree four") == want == brute.simhash(text)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(7, 3), (100, 101), (5, 5), (101, 102), (101, 102)] + [(200, x) for x in range(201, 260)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102)}, **{i: 200 for i in range(200, 260)}}
    assert components(spark.createDataFrame([(1, 1)], "u long, v long")).collect() == []


def test_keep_one(spark):
    rows = data.odd_rows()
    df = data.frame(spark, rows)
    kept = H.keep_one(df)
    assert kept.columns == df.columns
    items = [(i, brute.simhash(t)) for i, t, *_ in rows]
    parent = brute.roots([(n, f) for n, (_, f) in enumerate(items)], lambda a, b: (a[1] ^ b[1]).bit_count() <= 4)
    groups = {}
    for (i, _), g in zip(items, parent):
        groups.setdefault(g, []).append(i)
    want = sorted(min((i for i in ids if i is not None), default=-1) for ids in groups.values())
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == want


def test_empty_table(spark):
    none = data.frame(spark, [(1, "a", None, None)]).limit(0)
    assert H.near_duplicates(none).collect() == [] == H.keep_one(none).collect()


def _steps(monkeypatch, partitions):
    """The functions that ``links`` hands to its groups, in order."""
    steps = []

    class Frame:
        sparkSession = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: str(partitions)))

        def __getattr__(self, name):
            return lambda *_: self

        def applyInArrow(self, step, schema):
            steps.append(step)
            return self

    monkeypatch.setattr(H, "F", MagicMock())
    H.links(Frame())
    return steps


def _peak(step, *args):
    """Result of ``step`` and the most that Python and numpy held meanwhile, in bytes."""
    tracemalloc.start()
    try:
        return step(*args), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_group_is_answered_in_little_more_than_its_keys(monkeypatch):
    """Variants of a slice are held about twice, the keys of a bucket about once, at few partitions too."""
    send, answer, *_ = _steps(monkeypatch, 12)
    rng = np.random.default_rng(3)
    fps = rng.integers(-2**63, 2**63 - 1, 8 * H.SLICE)
    fps[1::8] = fps[::8] ^ 5                # each eighth has a neighbour
    sent, most = [], 0
    for chunk, some in enumerate(np.split(fps, 8)):
        group = pa.RecordBatch.from_pydict({"fp": some, "chunk": np.full(len(some), chunk)})
        got, peak = _peak(lambda: list(send((pa.scalar(chunk),), iter([group]))))
        sent += got
        most = max(most, peak)
    variants = 8 * H.SLICE * (1 + 64 + 64 * 63 // 2)
    assert most < 3 * variants
    table = pa.Table.from_batches(sent)
    sizes = [len(x) for x in table["keys"].to_pylist()]
    assert max(sizes) < 200_000
    assert 0.99 * 4 * variants < sum(sizes) <= 4 * variants
    one = table.filter(pc.equal(table["bucket"], 7))
    got, peak = _peak(answer, (pa.scalar(7, pa.int32()),), one)
    assert got.num_rows and peak < 1.7 * sum(len(x) for x in one["keys"].to_pylist())


def test_maps_make_values_of_few_rows_at_a_time():
    whole = pa.RecordBatch.from_pydict({"doc_id": list(range(2500)), "text": [str(i) for i in range(2500)]})
    got = list(sliced([whole, whole.slice(0, 0), whole.slice(7, 3)]))
    assert [b.num_rows for b in got] == [1024, 1024, 452, 3]
    assert pa.Table.from_batches(got) == pa.concat_tables([pa.Table.from_batches([whole]), pa.Table.from_batches([whole.slice(7, 3)])])
