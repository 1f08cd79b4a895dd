"""Quality classifier: histogram gradient-boosted trees over document statistics.

A text becomes a fixed row of statistics (sizes, character classes, repetition,
line shapes). Trees are fitted on a bounded sample of labelled rows: features
are cut into at most ``BINS`` quantile bins, and each split is the best of the
gradient histograms. The trees are flattened into arrays (feature, threshold,
children, value), and a batch of documents descends all of them by numpy
indexing, one step per level. Scoring is one map over the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality_rules import statistics
from .words import word_hashes

BINS = 64


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled ids that are taken, those of the smallest
    hashes, and the rows fitted: different texts of these ids, by the texts' hashes
    where the ids have more texts than that."""

    sample_rows: int = 20_000
    trees: int = 60
    depth: int = 4
    rate: float = 0.15
    l2: float = 1.0
    min_rows: int = 10


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth, level by level: node i has children 2i+1, 2i+2."""

    feature: np.ndarray          # tree x inner node
    threshold: np.ndarray        # tree x inner node; above it, right
    value: np.ndarray            # tree x leaf
    start: float                 # log odds before the first tree


_CLASSES = np.zeros((6, 256), np.int64)
for _row, _members in enumerate((range(0x30, 0x3A), range(0x41, 0x5B), b"#*$%&|<>", b".,;:!?", b"!", range(0xC2, 0xF5))):
    _CLASSES[_row, list(_members)] = 1

FEATURES = ("log_words", "word_length", "digits", "upper", "symbols", "punctuation", "bangs", "non_ascii",
            "dup_lines", "repeat_words", "distinct_words", "log_lines", "line_length", "top_word", "pipes",
            "single_char_words", "ends_in_stop", "log_longest_word")


def features(text: bytes) -> list[float]:
    """The statistics of a UTF-8 text; an empty text is a row of zeros."""
    words = word_hashes(text)
    if not len(words):
        return [0.0] * len(FEATURES)
    n, chars, _, dup, repeat = statistics(text, words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    digits, upper, symbols, punctuation, bangs, lead = (_CLASSES @ counts) / chars
    _, per_word = np.unique(words, return_counts=True)
    lines = [x for x in text.split(b"\n") if x.strip()]
    split = text.split()
    stops = sum(x.rstrip()[-1:] in (b".", b"!", b"?") for x in lines)
    return [np.log1p(n), chars / n, digits, upper, symbols, punctuation, bangs, lead,
            dup / len(lines), repeat / n, len(per_word) / n, np.log1p(len(lines)), np.log1p(n / len(lines)),
            per_word.max() / n, counts[0x7C] / n, sum(len(w) == 1 for w in split) / n,
            stops / len(lines), np.log1p(max(map(len, split)))]


def matrix(texts: list[bytes | None]) -> np.ndarray:
    return np.array([features(x or b"") for x in texts], float).reshape(len(texts), len(FEATURES))


def grow(x: np.ndarray, y: np.ndarray, s: Settings) -> Trees:
    """Boosted trees for 0/1 labels ``y`` over the rows of ``x``."""
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], 1)    # v <= cuts[b]: bin <= b
    d, inner, leaves = x.shape[1], (1 << s.depth) - 1, 1 << s.depth
    feature = np.zeros((s.trees, inner), np.int64)
    threshold = np.full((s.trees, inner), np.inf)
    value = np.zeros((s.trees, leaves))
    score = np.full(len(y), start)
    for t in range(s.trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)                    # within its level
        for level in range(s.depth):
            width, base = 1 << level, (1 << level) - 1
            best, gain = np.zeros((width, 2), np.int64), np.zeros(width)
            total_g = np.bincount(node, g, width)
            total_h = np.bincount(node, h, width)
            for f in range(d):
                flat = node * BINS + binned[:, f]
                size = width * BINS
                left = [np.cumsum(np.bincount(flat, w, size).reshape(width, BINS), 1) for w in (g, h, None)]
                gl, hl, nl = left[0], left[1], left[2]
                gr, hr, nr = total_g[:, None] - gl, total_h[:, None] - hl, nl[:, -1:] - nl
                won = (gl * gl / (hl + s.l2) + gr * gr / (hr + s.l2) - (total_g**2 / (total_h + s.l2))[:, None])
                won[(nl < s.min_rows) | (nr < s.min_rows)] = 0
                won[:, len(cuts[f]):] = 0
                b = won.argmax(1)
                w = won[np.arange(width), b]
                better = w > gain + 1e-9
                gain[better], best[better, 0], best[better, 1] = w[better], f, b[better]
            split = gain > 0
            bound = np.where(split, best[:, 1], BINS)        # no split: all go left
            feature[t, base:base + width] = best[:, 0]
            threshold[t, base:base + width] = [cuts[f][b] if ok else np.inf for (f, b), ok in zip(best, split)]
            node = node * 2 + (binned[np.arange(len(y)), best[node, 0]] > bound[node])
        value[t] = -s.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + s.l2)
        score += value[t][node]
    return Trees(feature, threshold, value, start)


def probabilities(trees: Trees, x: np.ndarray) -> np.ndarray:
    """Chance of label 1 per row of ``x``: all rows descend all trees level by level."""
    n_trees, inner = trees.feature.shape
    score = np.full(len(x), trees.start)
    for i in range(0, len(x), 4096):
        rows = x[i:i + 4096]
        at = np.zeros((len(rows), n_trees), np.int64)
        tree = np.arange(n_trees)[None, :]
        for _ in range((inner + 1).bit_length() - 1):
            f = trees.feature[tree, at]
            at = 2 * at + 1 + (np.take_along_axis(rows, f, 1) > trees.threshold[tree, at])
        score[i:i + 4096] += trees.value[tree, at - inner].sum(1)
    return 1 / (1 + np.exp(-score))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(),
        id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees from ``docs`` and ``labels`` (its first column the id, its second 0
    or 1). Null ids and labels teach nothing; a row for each pair of a text and
    a label of one id does, equal ones once. Without any, every score is one half.

    The sampled ids (at most ``sample_rows``) are broadcast to the texts, so
    only the sampled texts are read into statistics, and no text is shuffled.
    At most ``sample_rows`` rows of statistics come back, however many rows
    the ids have.
    """
    known = labels.select(F.col(f"`{labels.columns[0]}`").alias("id"), F.col(f"`{labels.columns[1]}`").cast("int").alias("y"))
    known = known.where("id IS NOT NULL AND y IN (0, 1)")
    known = known.orderBy(F.xxhash64("id"), "id", "y").limit(settings.sample_rows)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    picked = src.join(F.broadcast(known), "id").select("text", "y", F.xxhash64("id", "text").alias("h"))

    def run(batches):
        for b in batches:
            x = matrix(b.column("text").cast(pa.binary()).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("h"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["h", "y", "x"])

    found = picked.mapInArrow(run, "h long, y int, x array<double>").dropDuplicates(["h", "y"])
    rows = found.orderBy("h", "y").limit(settings.sample_rows).collect()
    if not rows:
        return Trees(np.zeros((1, 1), np.int64), np.full((1, 1), np.inf), np.zeros((1, 2)), 0.0)
    rows.sort(key=lambda r: (r.y, r.x))
    return grow(np.array([r.x for r in rows]), np.array([float(r.y) for r in rows]), settings)


def score(docs: DataFrame, trees: Trees, name: str = "score", text_col: str = "text") -> DataFrame:
    """``docs`` with the chance of label 1 under ``name`` (free in ``docs``).

    Null and empty texts are scored by their row of zeros; very long ones are
    read whole. Other columns pass through. An empty table gives no rows.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {name} must be unused")
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            p = probabilities(trees, matrix(b.column(at).cast(pa.binary()).to_pylist()))
            yield b.append_column(name, pa.array(p))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))
