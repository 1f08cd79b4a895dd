"""Small inputs for the operators: odd rows, copies, clashing columns."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

# columns whose names an operator might use for itself
CLASHES = ("chunk", "bucket", "fp", "size", "copies", "score", "keep_id", "Own_Hash", "mix_band", "part", "rank", "secrets")


def frame(spark, rows, clashes=True):
    """Documents from ``(doc_id, text, lang, source)``, with clashing extra columns."""
    df = spark.createDataFrame([(i, t, la, s, len(t) if t else None) for i, t, la, s in rows], DOCS)
    if clashes:
        df = df.selectExpr("*", *(f"'x' AS {c}" for c in CLASHES))
    return df


def sentence(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def odd_rows(seed=3):
    """Nulls, empty and separator-only texts, copies of a text under many ids,
    repeated rows, null ids, repeated ids, a very long text, near copies."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    passage = sentence(rng, 60)
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, None), (None, base, "en", "b"),
            (None, base, "en", "b"), (4, base, None, "c"), (4, base, None, "c"), (4, sentence(rng, 50), "de", None),
            (None, None, None, None), (5, "short text", "en", "a"), (5, "short text", "en", "a"),
            (6, "nbsp is no separator \U0001f600 here", "fr", "ü"), (7, "the " * 500, "en", "z"),
            (8, sentence(rng, 40_000), "de", "b")]
    rows += [(10 + i, base, "en", "b") for i in range(30)]
    rows += [(50 + i, base + f" tail{i}", "en", "c") for i in range(12)]
    rows += [(70 + i, sentence(rng, rng.randrange(40, 300)) + "\n" + passage + "\t" + sentence(rng, 45), "en", f"s{i % 4}")
             for i in range(12)]
    rows += [(100 + i, sentence(rng, rng.randrange(1, 200)), ("en", "de", "fr")[i % 3], f"s{i % 4}") for i in range(40)]
    rng.shuffle(rows)
    return rows
