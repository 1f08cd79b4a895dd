"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed character n-grams of the lower-cased letters of a text
(other characters part words and count as one boundary), weighted by term
frequency and inverse document frequency and normalised to length one. The
document frequencies come from every training text: each task counts into one
array of fixed size, and Spark sums the arrays by bucket. The weights are
trained with follow-the-regularised-leader (per-coordinate rates, elastic-net
penalties, so most weights are exactly zero) on a bounded sample of labelled
texts, and a temperature fitted on a part kept apart calibrates the scores.
The model is a table of ``BUCKETS`` rows; scoring is one map over the texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from .columns import sliced
from .words import mix

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled texts that are fitted, drawn by their
    hashes: the same share of each label as far as it has any; copies of a text
    count once.
    Every fifth of them, by hash, only calibrates."""

    sample_rows: int = 2_000
    epochs: int = 3
    rate: float = 1.0            # FTRL alpha
    beta: float = 1.0
    l1: float = 0.002
    l2: float = 0.002


@dataclass(frozen=True)
class Model:
    labels: tuple[str, ...]
    idf: np.ndarray              # per bucket
    weights: np.ndarray          # bucket x label
    bias: np.ndarray
    temperature: float


_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    """For every code point whether it is a letter; made once per process."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    """Lower-cased letters of a text, each run of other characters as one 0;
    empty if the text has no letter."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letter_table()[raw]
    if not letter.any():
        return np.zeros(0, np.uint64)
    points = np.concatenate([[0], np.where(letter, raw, 0), [0]]).astype(np.uint64)
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    return points[keep]


def term_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's n-grams, ascending, and how often each occurs."""
    points = code_points(text) if text else np.zeros(0, np.uint64)
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = []
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    with np.errstate(over="ignore"):
        grams = np.zeros(len(points), np.uint64)
        for n in ORDERS:
            if len(points) < n:
                break
            grams = grams[:len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1:] + np.uint64(n)
            found.append((mix(grams) >> shift).astype(np.int64))
    total = np.bincount(np.concatenate(found), minlength=BUCKETS)
    some = np.flatnonzero(total)
    return some, total[some]


def vector(text: str | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """TF-IDF of a text: buckets and values of length one; empty without letters."""
    at, n = term_counts(text)
    if not len(at):
        return at, n.astype(float)
    x = (1 + np.log(n)) * idf[at]
    return at, x / np.sqrt((x * x).sum())


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Per bucket the number of rows of ``texts(text)`` with it, and the number of rows."""

    def run(batches):
        seen, rows = np.zeros(BUCKETS + 1, np.int64), 0
        for b in sliced(batches):
            for text in b.column("text").to_pylist():
                seen[term_counts(text)[0]] += 1
                rows += 1
        seen[BUCKETS] = rows        # the last entry counts the rows
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(seen[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS + 1, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n         # at most BUCKETS + 1 rows
    return out[:BUCKETS], int(out[BUCKETS])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def _ftrl(rows: list, n_labels: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias after ``epochs`` passes over ``rows`` of (buckets, values, label)."""
    z, n = np.zeros((BUCKETS + 1, n_labels)), np.zeros((BUCKETS + 1, n_labels))

    def leader(z, n):
        w = -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.rate + s.l2)
        return np.where(np.abs(z) <= s.l1, 0.0, w)

    rng = np.random.Generator(np.random.PCG64(1))
    for _ in range(s.epochs):
        for i in rng.permutation(len(rows)):
            at, x, y = rows[i]
            at, x = np.append(at, BUCKETS), np.append(x, 1.0)       # the last row is the bias
            zz, nn = z[at], n[at]
            w = leader(zz, nn)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p[None, :]
            sigma = (np.sqrt(nn + g * g) - np.sqrt(nn)) / s.rate
            z[at] = zz + g - sigma * w
            n[at] = nn + g * g
    w = leader(z, n)
    return w[:BUCKETS], w[BUCKETS]


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that minimises the log loss, by golden section over its logarithm."""
    if not len(logits):
        return 1.0

    def loss(t):
        p = _softmax(logits / math.exp(t))
        return -np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()

    lo, hi, r = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def fit(train: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model from ``train(text, lang)``; rows with null text or lang teach
    nothing. None if no row is left."""
    train = train.select("text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    # texts by hash, so that copies count once
    hashed = train.withColumn("h", F.xxhash64("text"))
    texts = hashed.select("lang", "h").distinct()
    sizes = {r.lang: r.n for r in texts.groupBy("lang").agg(F.count("*").alias("n")).collect()}    # one row per label
    if not sizes:
        return None
    labels = tuple(sorted(sizes))
    each = -(-settings.sample_rows // len(labels))
    # about four times as many as needed pass a cut on the hash, so that the ranking never gathers a whole label
    cut = F.create_map(*(F.lit(x) for label in labels for x in (label, min(1.0, 4 * each / sizes[label]))))
    drawn = texts.where(F.pmod(F.xxhash64("h"), F.lit(1 << 32)) < cut[F.col("lang")] * float(1 << 32))
    rank = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    # the chosen hashes are at most sample_rows + labels
    chosen = drawn.withColumn("rank", rank).where(F.col("rank") <= each).select("lang", "h")
    sample = hashed.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h").agg(F.min("text").alias("text"))

    seen, rows = document_frequencies(train)
    idf = np.log((1 + rows) / (1 + seen)) + 1

    def features(batches):
        for b in batches:
            got = [vector(x, idf) for x in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("lang"), pa.array([v[0].astype("<i4").tobytes() for v in got], pa.binary()),
                 pa.array([v[1].astype("<f4").tobytes() for v in got], pa.binary())], names=["lang", "at", "x"])

    index = {label: i for i, label in enumerate(labels)}
    data = [(np.frombuffer(r.at, "<i4").astype(np.int64), np.frombuffer(r.x, "<f4").astype(float), index[r.lang])
            for r in sample.mapInArrow(features, "lang string, at binary, x binary").collect() if len(r.at)]
    if not data:
        return None
    data.sort(key=lambda d: (d[2], d[0].tobytes(), d[1].tobytes()))
    apart = [d for i, d in enumerate(data) if i % 5 == 4]
    weights, bias = _ftrl([d for i, d in enumerate(data) if i % 5 != 4], len(labels), settings)
    logits = np.array([x @ weights[at] + bias for at, x, _ in apart]).reshape(len(apart), len(labels))
    return Model(labels, idf, weights, bias, _temperature(logits, np.array([d[2] for d in apart], int)))


def predict_text(model: Model | None, text: str | None) -> tuple[str, float]:
    """Label and its calibrated probability; (``und``, 0.0) without a letter or a model."""
    if model is None:
        return UNKNOWN, 0.0
    at, x = vector(text, model.idf)
    if not len(at):
        return UNKNOWN, 0.0
    p = _softmax((x @ model.weights[at] + model.bias) / model.temperature)
    i = int(p.argmax())             # the first label on a tie
    return model.labels[i], float(p[i])


def predict(docs: DataFrame, model: Model | None, names: tuple[str, str] = ("lang_pred", "score"),
            text_col: str = "text") -> DataFrame:
    """``docs`` with the predicted label and its probability under ``names``.

    Null text and texts without a letter are ``und`` with score 0. Very long
    texts are read whole. ``names`` must be free in ``docs`` (in any case);
    other columns pass through. An empty table gives no rows.
    """
    if len({n.lower() for n in (*docs.columns, *names)}) < len(docs.columns) + 2:
        raise ValueError(f"columns {names} must be unused")
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)       # BUCKETS x labels

    def run(batches):
        for b in sliced(batches):
            got = [predict_text(shared.value, x) for x in b.column(at).to_pylist()]
            for name, i, kind in ((names[0], 0, pa.string()), (names[1], 1, pa.float64())):
                b = b.append_column(name, pa.array([g[i] for g in got], kind))
            yield b

    added = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return docs.mapInArrow(run, T.StructType(docs.schema.fields + added))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text, mod 4, is 2; null for a null id, which
    then neither is held out nor teaches."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2
