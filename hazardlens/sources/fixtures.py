"""Derived ``raw_inspections`` input built from the driver's TPC-H-style tables.

Mapping: order -> inspection, customer -> establishment, line items + parts
-> violation text, nation -> alias and ZIP. Every tenth-ish case injects the
dirt the cleaning step must handle (bad dates, unusable results, blank or
null licences, duplicated ids, padded text, bad coordinates).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread

# FIXED VALUES of the derived fixture (shared with the SQL oracle text).
COMMENT_BY_SUPPKEY_MOD10 = [
    "OBSERVED MICE DROPPINGS NEAR ",
    "Cold holding temperature at 50F for ",
    "floor and wall dusty around ",
    "Found roaches and raw meat on ",
    "no sanitizer at ",
    "e. coli risk, cross-contamination of ",
    "butterfly stored with ",
    "labeling missing on ",
    "sewage leaking by ",
    "instructed to clean ",
]
TYPE_BY_ORDERKEY_MOD9 = [
    "Suspect Food Poisoning", "Complaint", " Task-Force", "Canvass Re-Inspection",
    "CANVASS ", "License", "Consultation", "Recent Inspection", None,
]
DUPLICATE_EVERY = 50
VIOLATION_SEPARATOR = " | "


_RELATIONS: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver's (read-only) table as a relation, resolved once per session.

    Listing and footer/schema resolution happen once; every query still
    scans the files when it runs. This plays the role of a catalog's cached
    table metadata. A different session gets its own relation.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _RELATIONS.get(path)
    if hit is not None and hit[0] is spark:
        return hit[1]
    rel = spark.read.parquet(path)
    _RELATIONS[path] = (spark, rel)
    return rel


def _case(key: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(key == i, F.lit(v)) if expr is None else expr.when(key == i, F.lit(v)))
    return expr


def violation_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One violations string per order: sorted fragments joined by a pipe.

    Hash-aggregates on ``l_orderkey`` (partial collect per map task); the
    part side joins by key, broadcast only if AQE measures it small.
    """
    li = spread(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
                "l_orderkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    frag = F.concat(
        ((F.col("l_partkey") + F.col("l_linenumber")) % 75).cast("string"), F.lit(". "),
        F.upper("p_type"), F.lit(" - Comments: "),
        _case(F.col("l_suppkey") % 10, COMMENT_BY_SUPPKEY_MOD10), F.col("p_name"))
    return (li.join(part, li.l_partkey == part.p_partkey)
            .groupBy("l_orderkey")
            .agg(F.array_join(F.sort_array(F.collect_list(frag)), VIOLATION_SEPARATOR).alias("violations")))


def raw_inspections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw landed records (all text + ``ingest_seq``), derived from the tables."""
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"]
    # Every order lands once (ingest_seq 0); every DUPLICATE_EVERY-th is re-sent later (1).
    copies = (F.when(F.col("o_orderkey") % DUPLICATE_EVERY == 0, F.array(F.lit(0), F.lit(1)))
              .otherwise(F.array(F.lit(0))).cast("array<bigint>"))
    ords = table(spark, sf_dir, "orders").select(*cols, F.explode(copies).alias("ingest_seq"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    viol = violation_text(spark, sf_dir)

    ck, ok = F.col("o_custkey"), F.col("o_orderkey")
    j = (ords.join(cust, ords.o_custkey == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == nation.n_nationkey)
         .join(viol, ok == viol.l_orderkey, "left"))
    code = ck % 1000
    pad3 = F.lpad(code.cast("string"), 3, "0")
    return j.select(
        ok.cast("string").alias("inspection_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("dba_name"),
        F.when(ck % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("aka_name"),
        F.when(ck % 11 == 0, F.lit(None).cast("string")).when(ck % 13 == 0, F.lit("   "))
         .otherwise(ck.cast("string")).alias("license_"),
        F.col("c_mktsegment").alias("facility_type"),
        _case(ck % 3, ["Risk 1 (High)", "Risk 2 (Medium)", "Risk 3 (Low)"]).alias("risk"),
        F.concat(ck.cast("string"), F.lit(" N "), F.col("n_name"), F.lit(" ST")).alias("address"),
        F.when(F.col("c_nationkey") == 24, F.lit(None).cast("string"))
         .otherwise((F.lit(60600) + F.col("c_nationkey")).cast("string")).alias("zip"),
        F.when(ok % 97 == 0, F.lit("n/a")).otherwise(F.col("o_orderdate").cast("string")).alias("inspection_date"),
        _case(ok % 9, TYPE_BY_ORDERKEY_MOD9).alias("inspection_type"),
        F.when(F.col("ingest_seq") == 1, F.lit("Fail"))
         .when(ok % 13 == 0, F.lit("Out of Business"))
         .when(ok % 17 == 0, F.lit("No Entry"))
         .when(ok % 101 == 0, F.lit(None).cast("string"))
         .when(F.col("o_orderstatus") == "F", F.lit("Fail"))
         .when(F.col("o_orderstatus") == "O", F.lit(" Pass"))
         .otherwise(F.lit("Pass w/ Conditions")).alias("results"),
        F.col("violations"),
        F.when(ck % 19 == 0, F.lit(None).cast("string")).when(ck % 23 == 0, F.lit("bad"))
         .otherwise(F.concat(F.lit("41."), pad3)).alias("latitude"),
        F.when(ck % 19 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("-87."), pad3)).alias("longitude"),
        F.col("ingest_seq"),
    )


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second free-text input for the keyword scan (whole texts)."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
