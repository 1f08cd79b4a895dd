import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hazardlens.llm.mixing import emit, mix, source_targets

from . import brute, data


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 5, "d": 1, None: 500}, {"x": 7}, {None: 3}, {"a": 0, "b": 10},
    {"ä": 5, "z": 900, "Z": 30, "\U0001f600": 1, "ﬀ": 2, None: 1}, {f"s{i:03}": (i * 7919) % 1000 for i in range(60)},
    {"hot": 10**9, **{f"t{i}": i + 1 for i in range(9)}}])
def test_targets_match_resharing_in_rounds(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r for r in source_targets(df).collect()}
    want = brute.targets(sizes)
    assert {s: r.source_size for s, r in got.items()} == sizes
    assert {s: r.target for s, r in got.items()} == pytest.approx(want)


def test_odd_rows(spark):
    rows = data.odd_rows()
    df = data.frame(spark, rows)
    names = ("n_size", "n_source", "n_target", "n_copies")
    out = mix(df, names=names)
    assert out.columns == [*df.columns, *names]
    got = out.collect()
    assert Counter((r.doc_id, r.text, r.source, r.n_size) for r in got) == Counter((i, t, s, len(brute.words(t))) for i, t, _, s in rows)
    sizes = defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(brute.words(t))
    want = brute.targets(dict(sizes))
    assert len(sizes) > 6 and None in sizes
    assert all(r.n_source == sizes[r.source] and r.n_target == pytest.approx(want[r.source]) for r in got)
    assert all(0 <= r.n_copies <= 3 for r in got)
    copies = Counter((r.doc_id, r.text, r.source) for r in emit(df).collect())
    taken = Counter()
    for r in got:
        taken[r.doc_id, r.text, r.source] += r.n_copies
    assert copies == +taken and emit(df).columns == df.columns
    with pytest.raises(ValueError):
        mix(df)                                           # "size" is taken
    assert mix(df.limit(0), names=names).collect() == [] == emit(df.limit(0)).collect()


def test_systematic_counts_and_reruns(spark):
    """Each source emits its expected number of copies to within one, and the
    same documents again from any partitioning."""
    rng = random.Random(5)
    rows = [(i, data.sentence(rng, rng.choice([3, 3, 3, 20, 150])), None, "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    df = data.frame(spark, rows, clashes=False)
    got = mix(df).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        rate = own[0].target / own[0].source_size
        assert abs(sum(r.copies for r in own) - rate * len(own)) < 1 + 1e-6
        assert all(r.copies in (int(rate), int(rate) + 1) for r in own)
        taken = sum(r.copies * r.size for r in own)
        assert abs(taken - own[0].target) <= 0.05 * own[0].target + 150
    again = mix(df.repartition(5, F.col("text"))).collect()
    assert sorted((r.doc_id, r.copies) for r in got) == sorted((r.doc_id, r.copies) for r in again)


def test_no_python_in_the_plan(spark):
    plan = emit(data.frame(spark, data.odd_rows()))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_a_null_source_is_the_last(spark):
    rows = [(i, "w " * 10, None, (None, "a", "z", "\U0001f600")[i % 4]) for i in range(400)]
    got = {r.source: (r.target, r.source_size) for r in mix(data.frame(spark, rows, clashes=False)).collect()}
    want = brute.targets({s: 1000 for s in (None, "a", "z", "\U0001f600")})
    assert {s: t for s, (t, _) in got.items()} == pytest.approx(want) and want["a"] == want[None] < want["z"]
