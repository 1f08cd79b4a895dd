"""The corpus pipeline over ``documents``: language ID, SimHash near-duplicates,
secret scan, mixing to target weights, packing.

Each stage takes what its predecessor kept as ``docs`` and returns whole rows
with the columns of ``documents``; the last returns the packed pieces. Between
stages the rows are written to the shared folder and read again, so a lost
executor repeats part of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.llm import language_id, mixing, packing, secret_scan, simhash
from hazardlens.llm.columns import unused
from hazardlens.session import staged

MIN_LANGUAGE_SCORE = 0.35     # below it a text counts as in no learned language


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language, by a model of the rows
    that may teach; null texts, texts without letters and texts that no
    language fits go. Without any labelled row nothing is learned, and all go."""
    pred, score = unused(docs, "lang_pred", "lang_score")
    model = language_id.fit(docs.where(~language_id.held_out(F.col("doc_id"))).select("text", "lang"))
    judged = language_id.predict(docs, model, (pred, score))
    fits = (F.col(pred) != language_id.UNKNOWN) & (F.col(score) >= MIN_LANGUAGE_SCORE)
    return judged.where(fits).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that of the smallest id."""
    return simhash.keep_one(docs, shingle=4, distance=4)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; ``n_chars`` follows a
    changed text."""
    old, = unused(docs, "old_hash")
    clean = secret_scan.redact(docs.withColumn(old, F.xxhash64("text")))
    if "n_chars" in docs.columns:
        changed = F.xxhash64("text") != F.col(old)
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.emit(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and the ids themselves."""
    pieces = packing.pack(docs, tokenizer="word_bpe_49k.json", end_id=2, window=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "ids")


STAGES = [
    ("language ID", language_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("secret scans", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

# The models, the fingerprints and the tokenizer are not expressible in SQL; the
# tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
