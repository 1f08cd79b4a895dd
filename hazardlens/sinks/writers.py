"""Sinks (K1-K9): file writes, table refresh and file layout.

Writes go to paths (or catalog tables) given by the caller; on a cluster
these live in shared storage. All writes are whole-table ``overwrite`` or
``append`` by Spark's committers, so a lost executor just re-runs its task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.profiling import key_check
from ..schemas import INSPECTION_COLUMNS, to_sink_schema
from ..session import staged
from ..sources.files import CSV_OPTIONS


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", max_records: int = 0) -> None:
    """K1/K2/K3: CSV with header; nested columns are dropped (CSV cannot hold them).

    ``max_records`` (0: no limit) bounds the records of a file. A multi-line file
    can't be split, so it also bounds what one task reads back.
    """
    keep = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("array", "struct", "map")]
    df.select(keep).write.mode(mode).options(**CSV_OPTIONS).option("maxRecordsPerFile", max_records).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def inspections_for_load(df: DataFrame) -> DataFrame:
    """K5: keep the known inspection columns that exist, in table order."""
    return df.select([c for c in INSPECTION_COLUMNS if c in df.columns])


def scores_for_load(df: DataFrame) -> DataFrame:
    """K6: drop rows without an establishment key."""
    return df.dropna(subset=["establishment_id"])


def require_key(df: DataFrame, key: str, table_name: str) -> DataFrame:
    """K7 as a gate: raise unless ``key`` is present and unique in every row."""
    require_key_count(df, key, table_name)
    return df


def require_key_count(df: DataFrame, key: str, table_name: str) -> int:
    """``require_key`` that gives the number of rows it has counted."""
    found = key_check(df, key, table_name).first()
    if found.n_rows and (found.null_keys or found.duplicate_keys):
        raise ValueError(f"{table_name}: {found.null_keys} null and {found.duplicate_keys} duplicate values of {key}")
    return found.n_rows or 0


def switch_in(spark: SparkSession, path: str, write) -> None:
    """Replace the table folder ``path`` by what ``write(new_path)`` writes.

    The new table is complete before the old one is touched, so a failed write
    or check leaves the table being served as it was. The old folder is kept
    beside it until the new one is in place.
    """
    path = path.rstrip("/")
    fresh, old = (f"{path}.{kind}-{uuid.uuid4().hex[:8]}" for kind in ("new", "old"))
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    fs = place(path).getFileSystem(conf)
    try:
        write(fresh)
        if fs.exists(place(path)) and not fs.rename(place(path), place(old)):
            raise OSError(f"cannot move {path}")
        if not fs.rename(place(fresh), place(path)):
            fs.rename(place(old), place(path))
            raise OSError(f"cannot move {fresh} to {path}")
    finally:
        if fs.exists(place(fresh)):
            fs.delete(place(fresh), True)
    if fs.exists(place(old)):
        fs.delete(place(old), True)
    spark.catalog.refreshByPath(path)


def refresh_tables(inspections: DataFrame, scores: DataFrame, inspections_path: str,
                   scores_path: str) -> None:
    """K4: full refresh of both tables with the sink types (REAL/INTEGER).

    Both are written beside the tables and pass the key check (K7) before
    either is switched in.
    """
    spark = inspections.sparkSession

    def put(df: DataFrame, key: str, name: str):
        def write(path: str) -> None:
            to_sink_schema(df).write.parquet(path)
            require_key(spark.read.parquet(path), key, name)
        return write

    scores_put = put(scores_for_load(scores), "establishment_id", "risk_scores")
    inspections_put = put(inspections_for_load(inspections), "inspection_id", "inspections")

    def write_both(path: str) -> None:
        inspections_put(path)
        switch_in(spark, scores_path, scores_put)      # a refused score table leaves both as they were

    switch_in(spark, inspections_path, write_both)


def refresh_catalog_tables(inspections: DataFrame, scores: DataFrame, inspections_table: str,
                           scores_table: str, location: str | None = None) -> None:
    """K4 as catalog tables: drop-and-recreate both with the sink types, after the key check.

    With ``location`` the tables are external (data under ``location`` in
    shared storage); otherwise they live in the session's warehouse.
    """
    ready = []
    for df, key, name, sub in (
            (inspections_for_load(inspections), "inspection_id", inspections_table, "inspections"),
            (scores_for_load(scores), "establishment_id", scores_table, "risk_scores")):
        ready.append((require_key(staged(to_sink_schema(df), sub), key, sub), name, sub))
    for df, name, sub in ready:
        w = df.write.mode("overwrite").format("parquet")
        if location:
            w = w.option("path", f"{location.rstrip('/')}/{sub}")
        w.saveAsTable(name)


def append_table(df: DataFrame, path: str) -> None:
    """K5/K6 append step."""
    to_sink_schema(df).write.mode("append").parquet(path)


def clustered_scores(scores: DataFrame, path: str, n_files: int | None = None) -> None:
    """K8: scores laid out by ZIP ranges, each ZIP's rows sorted by score descending.

    Parquet min/max statistics then let ZIP filters and score-range filters
    skip whole files / row groups — the file-layout analogue of the indexes.
    The range key continues past the ZIP (score, key), so one ZIP holding a
    large share of establishments is still split over several files. Without
    ``n_files`` the number of files follows the volume: AQE joins neighbouring
    ranges up to its advisory partition size.
    """
    order = [F.col("zip").asc_nulls_last(), F.col("dynamic_risk_score").desc(), F.col("establishment_id")]
    ranged = scores.repartitionByRange(n_files, *order) if n_files else scores.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def bucketed_inspections(inspections: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """K8: inspections bucketed by establishment and sorted by date in a catalog table,
    so per-establishment history windows and aggregations skip the shuffle.

    ``buckets`` is the caller's choice: table size over the bytes one task
    should read. Rows are dealt by bucket first, so each bucket is one file
    rather than one per writing task. (A bucket holds its establishments whole:
    that is what spares the later shuffle, and an establishment with very many
    inspections makes its bucket as large.) With ``path`` the table is external
    (data in shared storage, metadata in the session catalog)."""
    w = (inspections.repartition(buckets, "establishment_id").write.mode("overwrite").format("parquet")
         .bucketBy(buckets, "establishment_id").sortBy("establishment_id", "inspection_date"))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def jdbc_options(url: str, table: str, batchsize: int = 5_000, truncate: bool = False,
                 properties: dict | None = None) -> dict[str, str]:
    """Writer options of a database table; ``truncate`` keeps its definition (and indexes) on a refresh."""
    return {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": str(truncate).lower(), **(properties or {})}


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
               batchsize: int = 5_000, partitions: int | None = None, mode: str = "append", truncate: bool = False) -> None:
    """K5/K6 into a database table: sink types, ``batchsize``-row inserts, parallel writers.

    Each task opens its own connection and inserts its partition in batches;
    ``partitions`` caps the number of concurrent connections. (Needs a
    reachable database; none is started by this repository or its tests.)
    """
    out = to_sink_schema(df)
    if partitions:
        out = out.coalesce(partitions)
    out.write.format("jdbc").mode(mode).options(**jdbc_options(url, table, batchsize, truncate, properties)).save()


def refresh_jdbc(inspections: DataFrame, scores: DataFrame, url: str, properties: dict | None = None,
                 partitions: int | None = None, truncate: bool = False, write=write_jdbc) -> None:
    """K4 into a database: both tables pass the key check, then are dropped,
    created and filled (``truncate``: emptied and filled)."""
    tables = ((require_key(inspections_for_load(inspections), "inspection_id", "inspections"), "inspections"),
              (require_key(scores_for_load(scores), "establishment_id", "risk_scores"), "risk_scores"))
    for df, name in tables:
        write(df, url, name, properties, partitions=partitions, mode="overwrite", truncate=truncate)
