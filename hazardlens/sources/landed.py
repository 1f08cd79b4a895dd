"""Landed API pages.

The upstream API serves records in pages of ``PAGE_SIZE`` rows ordered by
``inspection_id``; a page is a JSON array of objects whose keys may vary
(absent keys = absent values). Here pages are files in a landing folder, each
line one page (an array) or one record (an object).

* ``read_pages`` reads any number of page files under one explicit schema and
  gives every record its landing order: that of its file, then place in the
  file. Files are ordered by the folder's manifest (``record_landing``), else by
  the numbers in their names; names that give no order are refused. A damaged
  page stops the read; ``damaged_pages`` lists such lines instead.
* ``read_all_keys`` reads every key that occurs in the records, under a name of
  its own where keys clash with each other or with a column of a later step.
* ``assign_pages`` / ``ordered_page`` give every record its page number under
  a *global* order without a single-partition window.
* ``land_pages`` lands a frame as page files (support for the fixtures).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PAGE_SIZE
from ..operators.ordering import global_row_index
from ..schemas import DERIVED, LANDING, RAW, RAW_TEXT_COLUMNS

DEFAULT_ORDER = ("inspection_id", "ingest_seq")


MANIFEST = "_manifest"            # folder beside the pages; Spark's readers pass over it
MANIFEST_SCHEMA = "file string, arrival long, position long"
BROADCAST_FILES = 200_000         # files up to which their orders are sent to every task (about 20 MB)


def natural_key(name: Column) -> Column:
    """Text that sorts like ``name`` with its numbers taken as numbers: each run of
    digits, without leading zeros, follows its own length."""
    def one(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.when(part.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 4, "0"), digits)).otherwise(part)
    return F.array_join(F.transform(F.regexp_extract_all(name, F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), one), "")


def natural_entries(files: DataFrame) -> DataFrame:
    """For ``in_landing_order``: each ``file``'s path in natural order, so that
    ``page_9`` comes before ``page_10``."""
    return files.select(F.col("file").alias("_listed"), natural_key(F.col("file")).alias("_order"))


def in_landing_order(placed: DataFrame, entries: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns`` of records just read, with their landing order: that of the file, then place in it.

    ``placed`` tells each record's ``_file``, the ``_block`` where its split
    starts and the running id ``_line``: a split is read by one task in file
    order, where the id rises. ``entries`` has one row per file, ``_listed`` and
    its ``_order``, so that the order is made once per file and not once per
    record; up to ``BROADCAST_FILES`` it is sent along, beyond that Spark joins
    by file. The struct compares field by field, and no two records share one;
    it is null for a file without an order.
    """
    if entries.count() <= BROADCAST_FILES:
        entries = F.broadcast(entries)
    found = placed.join(entries, F.col("_file") == F.col("_listed"), "left")
    place = F.struct(F.col("_order").alias("file"), F.col("_block").cast("long").alias("block"), F.col("_line").alias("line"))
    return found.select(*(F.col(f"`{c}`") for c in columns), F.when(F.col("_order").isNotNull(), place).alias(LANDING))


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file``: the paths of the files, as readers report them. No content is read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("_metadata.file_path").alias("file"))


def unordered_folders(files: DataFrame) -> DataFrame:
    """The folders whose file names give no landing order: names that are alike
    but for leading zeros, or that differ in more than their numbers. (Names
    without any number are in the order of the letters.)"""
    name = F.regexp_extract("file", "([^/]*)$", 1)
    return (files.groupBy(F.regexp_extract("file", "^(.*/)[^/]*$", 1).alias("folder"))
            .agg(F.count(F.lit(1)).alias("n_files"),
                 F.count_distinct(natural_key(name)).alias("n_orders"),
                 F.count_distinct(F.regexp_replace(name, "[0-9]+", "#")).alias("n_kinds"),
                 F.max(name.rlike("[0-9]")).alias("numbered"))
            .where("n_orders < n_files OR (n_kinds > 1 AND numbered)"))


def require_order(spark: SparkSession, paths: list[str]) -> None:
    bad = unordered_folders(_files(spark, paths)).first()
    if bad:
        raise ValueError(f"the {bad.n_files} file names in {bad.folder} give no landing order; "
                         "name them by page number or offset, or keep a manifest (record_landing)")


def _root(spark: SparkSession, path: str) -> str:
    """The folder as ``_plain`` shows it in the paths of its files."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return re.sub("^(file:)/+", r"\1/", fs.makeQualified(place).toUri().toString().rstrip("/"))


def _plain(file: str) -> Column:
    """A reader's file path; ``file:///x`` and ``file:/x`` are one."""
    return F.regexp_replace(file, "^(file:)/+", "$1/")


def record_landing(spark: SparkSession, path: str, arrival: int | None = None, positions: DataFrame | None = None) -> int:
    """Note in the folder's manifest the files that landed in ``path`` since the last time.

    A later call has a higher ``arrival`` (given, or the next one). ``positions``
    (``file`` below the folder, ``position``: page number or offset) orders the
    files of one arrival; without it their names must. Returns the arrival.
    """
    known = read_manifest(spark, path)
    landed = _files(spark, [path]).select(F.substr(_plain("file"), F.lit(len(_root(spark, path)) + 2)).alias("file"))
    if known is not None:
        landed = landed.join(known.select("file"), "file", "left_anti")
        if arrival is None:
            arrival = (known.agg(F.max("arrival")).first()[0] or 0) + 1
    arrival = 1 if arrival is None else arrival
    if positions is not None:
        landed = landed.join(positions.select("file", F.col("position").cast("long")), "file", "left")
        lost = landed.where("position IS NULL").first()
        if lost:
            raise ValueError(f"no position given for {lost.file}")
    else:
        bad = unordered_folders(landed).first()
        if bad:
            raise ValueError(f"the names of {bad.n_files} new files in {path} give no order: positions are needed")
        landed = landed.withColumn("position", F.lit(None).cast("long"))
    entries = landed.select("file", F.lit(arrival).cast("long").alias("arrival"), "position")
    entries.write.mode("append").json(f"{path.rstrip('/')}/{MANIFEST}")
    return arrival


def read_manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """``file, arrival, position`` of a landing folder, or None if it keeps no manifest."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{MANIFEST}")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    return spark.read.schema(MANIFEST_SCHEMA).json(place.toString())


def _in_order(spark: SparkSession, df: DataFrame, paths: list[str]) -> DataFrame:
    """``df`` of a file reader with the landing order: by the manifest of the
    folders if they keep one, else by the names, which must give an order.

    A file that its folder's manifest does not list has no order yet, which the
    dedup refuses.
    """
    kept = [(p, m) for p in paths if (m := read_manifest(spark, p)) is not None] if not any("*" in p for p in paths) else []
    cols, file = df.columns, "_metadata.file_path"
    place = (F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line"))
    if not kept:
        require_order(spark, paths)
        return in_landing_order(df.select("*", F.col(file).alias("_file"), *place), natural_entries(_files(spark, paths)), cols)
    if len(kept) < len(paths):
        raise ValueError("some of the landing folders keep a manifest and some do not")
    entries = None
    for i, (path, manifest) in enumerate(kept):
        order = natural_key(F.concat_ws("/", F.col("arrival"), F.lit(i), F.coalesce(F.col("position"), F.lit(0)), F.col("file")))
        some = manifest.select(F.concat(F.lit(_root(spark, path) + "/"), "file").alias("_listed"), order.alias("_order"))
        entries = some if entries is None else entries.unionByName(some)
    return in_landing_order(df.select("*", _plain(file).alias("_file"), *place), entries.dropDuplicates(["_listed"]), cols)


def page_schema(extra: Sequence[str] = (), with_seq: bool = False) -> T.StructType:
    """The declared text columns, then ``extra`` ones; ``with_seq`` adds a landed ``ingest_seq``."""
    fields = [T.StructField(c, T.StringType()) for c in [*RAW_TEXT_COLUMNS, *extra]]
    return T.StructType(fields + ([RAW["ingest_seq"]] if with_seq else []))


def read_pages(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
               multiline: bool = False) -> DataFrame:
    """Read landed pages under an explicit schema (absent keys -> null).

    Without ``schema`` the declared columns are read. Every record gets its
    ``landing`` order, which the dedup keeps the last by. A damaged page (cut
    short, not JSON) raises: a page holds up to ``PAGE_SIZE`` records, and none
    may be lost unnoticed. ``multiline=True`` reads raw API responses saved one
    pretty-printed array per file.
    """
    paths = _paths(path)
    schema = schema or page_schema()
    df = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(paths)
    return _in_order(spark, df, paths)


def damaged_pages(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """The lines that ``read_pages`` refuses: ``file``, the ``page`` text itself, and
    the ``inspection_id`` that could be read of it, if any."""
    paths = _paths(path)
    schema = page_schema().add("_corrupt_record", "string")
    df = (spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE").json(paths))
    # a query of the damage column alone is refused by the reader, so a parsed one stays
    return (df.select(F.col("_metadata.file_path").alias("file"), F.col("_corrupt_record").alias("page"), "inspection_id")
            .filter(F.col("page").isNotNull()))


def _records(spark: SparkSession, paths: list[str], multiline: bool) -> DataFrame:
    """``r``: every record as a map from its keys to their texts, of pages (arrays)
    and of single records (objects) alike. A damaged one raises when it is read."""
    lines = spark.read.option("wholetext", multiline).text(paths).where(F.trim("value") != "")
    strict = {"mode": "FAILFAST"}
    page = F.from_json("value", "array<map<string,string>>", strict)
    one = F.array(F.from_json("value", "map<string,string>", strict))
    return lines.select(F.explode(F.when(F.ltrim("value").startswith("["), page).otherwise(one)).alias("r"),
                        F.col("_metadata"))


def landed_keys(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> list[str]:
    """Every key that occurs in the landed records: the declared columns first,
    then the others by name. One pass over the files; only names reach the driver."""
    records = _records(spark, _paths(path), multiline)
    found = {r.k for r in records.select(F.explode(F.map_keys("r")).alias("k")).distinct().collect()}
    known = [c for c in RAW_TEXT_COLUMNS if c in found]
    return known + sorted(found - set(known))


def column_names(keys: Sequence[str]) -> dict[str, str]:
    """The column of every landed key: the key itself, unless it equals, but for
    case, a column that is declared, that a later step adds, or that an earlier
    key has; or if a column cannot be called so (a dot, a backtick, a leading
    underscore). Such a key gets ``_landed`` (and a number) behind it."""
    out = {k: k for k in keys if k in RAW_TEXT_COLUMNS}
    taken = {c.lower() for c in (*RAW_TEXT_COLUMNS, *DERIVED)}
    for key in keys:
        if key in out:
            continue
        plain = re.sub("[.`]", "_", key).lstrip("_")
        name, n = key, 1
        while name.lower() in taken or name != re.sub("[.`]", "_", name).lstrip("_") or not name:
            name, n = f"{plain}_landed" + (str(n) if n > 1 else ""), n + 1
        taken.add(name.lower())
        out[key] = name
    return out


def read_all_keys(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> DataFrame:
    """The records with every key that any of them has, as text, and the
    landing order: the declared columns first (null where absent), then the
    others under their ``column_names``."""
    names = column_names(landed_keys(spark, path, multiline))
    extra = {k: c for k, c in names.items() if k not in RAW_TEXT_COLUMNS}
    if all(k == c for k, c in extra.items()):
        return read_pages(spark, path, page_schema(list(extra)), multiline)
    # a reader's schema cannot rename, so the records come as maps
    paths = _paths(path)
    cols = [F.col("r")[k].alias(c) for k, c in [*((c, c) for c in RAW_TEXT_COLUMNS), *extra.items()]]
    return _in_order(spark, _records(spark, paths, multiline), paths).select(*cols, LANDING)


def union_pages(parts: Sequence[DataFrame]) -> DataFrame:
    """Append already-loaded parts; the schema is the union of their columns."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def assign_pages(df: DataFrame, page_size: int = PAGE_SIZE, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """``order`` columns of every row with its ``row_index`` (0-based, global order) and ``page_no``.

    Only the order columns are sorted and indexed; ``order`` is a key, so whole
    rows can be joined back on it.
    """
    indexed = global_row_index(df.select(*order), [F.col(c).asc_nulls_first() for c in order])
    return indexed.withColumn("page_no", F.floor(F.col("row_index") / F.lit(page_size)).cast("long"))


def page_summary(paged: DataFrame) -> DataFrame:
    """Rows per page and the id range each page covers."""
    return (paged.groupBy("page_no")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.min("row_index").alias("first_row"), F.max("row_index").alias("last_row"))
            .orderBy("page_no"))


def ordered_page(df: DataFrame, page_no: int, page_size: int = PAGE_SIZE,
                 order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """S3: the rows of one page under the stable order, cut from the global index
    of the order columns and joined back; the same plan however deep the page."""
    paged = assign_pages(df, page_size, order)
    keys = paged.filter(F.col("page_no") == page_no).select(*(F.col(c).alias(f"_key_{c}") for c in order), "row_index")
    same = [df[c].eqNullSafe(keys[f"_key_{c}"]) for c in order]
    return df.join(keys, same).orderBy("row_index").select(*df.columns)


def store_pages(df: DataFrame, path: str, page_size: int = PAGE_SIZE, order: Sequence[str] = DEFAULT_ORDER) -> str:
    """S3 for many page requests: the rows stored in their order with ``row_index``
    and ``page_no``, sorted once. Each file holds a range of pages, which its
    statistics tell, so a page is read from the one or two files that hold it."""
    indexed = global_row_index(df, [F.col(c).asc_nulls_first() for c in order])
    paged = indexed.withColumn("page_no", F.floor(F.col("row_index") / F.lit(page_size)).cast("long"))
    paged.repartitionByRange("row_index").sortWithinPartitions("row_index").write.mode("overwrite").parquet(path)
    return path


def stored_page(spark: SparkSession, path: str, page_no: int) -> DataFrame:
    """The rows of one page of ``store_pages``, in order: a range read at any depth;
    only the page itself is sorted."""
    return spark.read.parquet(path).where(F.col("page_no") == page_no).orderBy("row_index").drop("row_index", "page_no")


def land_pages(df: DataFrame, path: str, page_size: int = PAGE_SIZE, columns: Sequence[str] | None = None,
               order: Sequence[str] = DEFAULT_ORDER, compression: str = "none") -> str:
    """Land ``df`` under ``path`` in ``order``, at most ``page_size`` records to a file, one per line.

    Rows are range-partitioned and sorted, so no page is ever gathered in one
    row. Null values are left out of each object, as the API does. With
    ``compression`` (``gzip``) the files are compressed, which readers tell by their
    names; such a file is read by one task. Returns ``path``.
    """
    cols = list(columns) if columns is not None else df.columns
    by = [F.col(c).asc_nulls_first() for c in order]
    (df.repartitionByRange(*by).sortWithinPartitions(*by).select(*cols)
     .write.mode("overwrite").option("maxRecordsPerFile", page_size).option("compression", compression).json(path))
    return path
