"""The queries ``opN_<name>`` over the driver's tables, and their DuckDB SQL.

Each query calls its operator over the whole table and derives the contract's
columns from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle as O
from . import language_id as L
from . import quality_rules as Q
from . import quality_trees as T
from . import secret_scan as S
from . import url_filter as U
from .line_dedup import drop_repeated_lines
from .mixing import mix
from .packing import pack
from .ranked_search import ranked
from .simhash import near_duplicates
from .substring_dedup import remove_repeats
from .token_alignment import link_counts
from .vector_search import top_k

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(O.SQL)


def query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return out.select("doc_id", "fingerprint", "component_id")


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.find_secrets(table(spark, sf_dir, "documents"))
    found = F.col("secrets")
    return out.select(
        "doc_id", *(S.count_of(found, k).alias(f"n_{k}") for k in S.BASE_KINDS),
        F.sha2(S.digest(found, S.BASE_KINDS), 256).alias("base_sha256"), S.digest(found).alias("spans"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer="word_bpe_49k.json", end_id=2, window=4096)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset")


@query
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return Q.judge(table(spark, sf_dir, "documents"), labels.where("quality = 1").select("doc_id"))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix(docs).select("doc_id", "size", "source_size", "target", taken)


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    apart = L.held_out(F.col("doc_id"))
    model = L.fit(docs.where(~apart).select("text", "lang"))
    found = L.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(apart, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    apart = L.held_out(F.col("doc_id"))
    trees = T.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "quality").where(~apart))
    return T.score(docs, trees).select(
        "doc_id", F.coalesce(apart, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = U.train(U.training_urls(spark))
    return U.judge(table(spark, sf_dir, "pages"), model, U.RULES).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return out.withColumnRenamed("item", "item_id")


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_counts(table(spark, sf_dir, "documents"), a="byte_bpe_50k.json", b="piece_bpe_32k.model")
