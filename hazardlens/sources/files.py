"""File and table sources."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import safe_timestamp
from ..schemas import LANDING, RAW, ensure_columns
from .landed import _in_order, column_names, page_schema

log = logging.getLogger(__name__)

# CSV options that keep text exactly: quoted multi-line fields, embedded
# quotes escaped by doubling, surrounding whitespace preserved, and the
# empty string kept distinct from null (null is written as ``\N``, the
# empty string as ``""``). ``enforceSchema`` off: the header of every file is
# checked against the column names, so a file in another order is refused.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\\N",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "enforceSchema": "false",
}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header under an explicit schema (no inference)."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def _csv_text(spark: SparkSession, path: str, null_value: str) -> DataFrame:
    """All columns of the file as text, named by the header. Files whose header
    differs from the first one's are refused when they are read."""
    return spark.read.options(**{**CSV_OPTIONS, "nullValue": null_value}).csv(path)


def read_csv_by_header(spark: SparkSession, path: str, schema: T.StructType,
                       null_value: str = "") -> DataFrame:
    """S4-S6 for files written elsewhere: columns matched **by header name**.

    (A user schema on the CSV reader binds columns by position, which is wrong
    for a file whose column order or extra columns differ.) Every column is
    read as text, then cast to ``schema`` with ``try_cast`` (unparseable ->
    null); absent columns become null and extra columns are dropped.
    ``null_value=""`` follows the common export convention (empty field =
    missing); our own files use ``\\N`` (see ``CSV_OPTIONS``).
    """
    df = ensure_columns(_csv_text(spark, path, null_value), T.StructType(
        [T.StructField(f.name, T.StringType()) for f in schema.fields]))
    return df.select([(F.col(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f.name).try_cast(f.dataType)).alias(f.name) for f in schema.fields])


def read_raw_csv(spark: SparkSession, path: str, null_value: str = "") -> DataFrame:
    """S4 for exported raw files: declared columns by header name, then every
    other column as it is, all text.

    A file's own ``ingest_seq`` orders the records; else they carry the reader's
    ``landing`` order: file path, then row (``multiLine`` makes each file a
    single split, so the row order inside a file is exact).
    """
    df = _csv_text(spark, path, null_value)
    has_seq = "ingest_seq" in df.columns
    names = [c if c.lower() in RAW.fieldNames() else column_names([c])[c] for c in df.columns]
    renamed = {c: n for c, n in zip(df.columns, names) if c != n}
    extra = [n for n in names if n.lower() not in RAW.fieldNames()]
    df = df.withColumnsRenamed(renamed)
    full = ensure_columns(df if has_seq else _in_order(spark, df, [path]), page_schema(extra))
    return full.select(*page_schema(extra).fieldNames(), F.col("ingest_seq").cast("long") if has_seq else LANDING)


def _absent(error: AnalysisException) -> bool:
    return (error.getCondition() or "") in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition: tuple[str, str, str, int] | None = None) -> DataFrame:
    """A database table. ``partition`` = (column, lower, upper, tasks) reads it in
    that many ranges; without it one task would read all, so it is required."""
    if partition is None:
        raise ValueError("a database read needs partition=(column, lower, upper, tasks)")
    column, lower, upper, tasks = partition
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", tasks).options(**(properties or {})).load())


def table_or_path(spark: SparkSession, table: str | None, path: str | None,
                  schema: T.StructType, fmt: str = "parquet", jdbc_url: str | None = None,
                  jdbc_properties: dict | None = None, jdbc_partition: tuple[str, str, str, int] | None = None,
                  optional: bool = False) -> DataFrame:
    """Database table (if ``jdbc_url`` is given and reachable), else catalog
    table, else files at ``path``.

    Only "cannot connect" and "not there" go on to the next source, and are
    logged; any other failure (rights, network, damaged metadata) is raised.
    With none of them there, ``optional`` sources (the inspections) give an
    empty frame with ``schema``; others (the scores) raise.
    """
    if jdbc_url and table:
        try:
            return read_jdbc(spark, jdbc_url, table, jdbc_properties, jdbc_partition)
        except Exception as error:  # noqa: BLE001 - narrowed to connection failures below
            if not _cannot_connect(error):
                raise
            log.warning("no connection to the database, reading files instead: %s", error)
    if table and spark.catalog.tableExists(table):
        return spark.table(table)
    if path:
        try:
            if fmt == "csv":
                return read_csv_by_header(spark, path, schema, null_value=CSV_OPTIONS["nullValue"])
            return spark.read.schema(schema).format(fmt).load(path)
        except AnalysisException as error:
            if not _absent(error):
                raise
            log.warning("nothing at %s", path)
    if optional:
        return spark.createDataFrame([], schema)
    raise FileNotFoundError(f"neither table {table} nor path {path} exists")


def _cannot_connect(error: Exception) -> bool:
    """Whether a JDBC failure says that the server was not reached (SQL state class 08)."""
    cause = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while cause is not None:
        if hasattr(cause, "getSQLState"):
            try:
                state = cause.getSQLState()
            except Exception:  # noqa: BLE001 - not an SQL exception after all
                state = None
            if state and state.startswith("08"):
                return True
        text = cause.toString() if hasattr(cause, "toString") else str(cause)
        if "java.net.ConnectException" in text or "java.net.UnknownHostException" in text:
            return True
        cause = cause.getCause() if hasattr(cause, "getCause") else None
    return False


def reparse_dates(df: DataFrame, cols: list[str]) -> DataFrame:
    """Text dates -> TIMESTAMP_NTZ, unparseable -> null."""
    return df.withColumns({c: safe_timestamp(F.col(c).cast("string")) for c in cols})
