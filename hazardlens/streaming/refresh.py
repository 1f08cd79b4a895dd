"""Refresh-on-arrival: a file stream over the landing folder of API pages.

The published workflow is a scheduled full drop-and-reload. Here the same
refresh runs as a Structured Streaming query over the landing folder:

* new page files are picked up by the JSON file source (explicit schema,
  damaged pages stop the query), with progress kept in the query checkpoint,
  so a restarted or retried job never re-reads or skips a page;
* ``foreachBatch`` stores the landed records once, and parses **only these**
  (the text stage is the dominant CPU cost);
* the inspections table is a folder per batch id: the previous table without
  the ids that the batch touched, plus the last landed record of each of
  those. The order is (batch, file, place in the file), so a correction in a
  later drop supersedes, whatever its content;
* disk: records are stored with zstd, the dedup of a batch shuffles ids and
  landing orders only, the touched ids are dropped where the previous table is
  read, scores are made of a part of the establishments at a time, and a query's
  shuffle files go with it;
* with ``buckets`` the tables are kept in hash buckets instead, of which a batch
  rewrites only those it touches (``streaming/incremental``);
* scores are recomputed for every establishment (recency moves with the
  clock) from the few columns that scoring reads; readers take the newest
  folder that has its completion marker, and older ones beyond ``keep`` go.

No watermark is needed: a score is a pure function of all of an
establishment's inspections, so a late record is simply part of the next
refresh — there is no windowed state to expire.
``Trigger.AvailableNow`` processes what has landed and stops — the streaming
equivalent of the scheduled run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_CONFIG, ScoringConfig
from ..operators.clean import clean, repeated_ids, usable_records
from ..operators.scoring import KEY, establishment_state, scores_of_state
from ..operators.signals import parse_violations
from ..schemas import BATCH, INSPECTION_COLUMNS, INSPECTIONS
from ..session import COMPACT, drop_staged, drop_staged_frame, shuffles_dropped, staging_path
from ..sinks import snapshots
from ..sinks.writers import clustered_scores
from ..sources.landed import in_landing_order, natural_entries, page_schema
from . import incremental

DONE_MARKER = "_BATCH_COMPLETE"
KEEP_OUTPUTS = 2
PARTS = 4                     # parts in which a large table is read and shuffled, at most
_FILE, _BLOCK, _LINE = "_file", "_block", "_line"


def landing_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None,
                   multiline: bool = False) -> DataFrame:
    """Streaming frame of raw records from page files as they land, with the file
    and split that each came from (``multiline=True`` for one array per file)."""
    # Page files may sit in any sub-folder layout; no partition columns are inferred.
    schema = page_schema()
    reader = (spark.readStream.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST")
              .option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing_dir).select(*schema.fieldNames(), F.col("_metadata.file_path").alias(_FILE),
                                           F.col("_metadata.file_block_start").alias(_BLOCK))


def _fs(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _complete(spark: SparkSession, out_dir: str) -> list[str]:
    """Complete batch folders under ``out_dir``, oldest first."""
    root = out_dir.rstrip("/")
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(path) if s.getPath().getName().startswith("batch="))
    return [f"{root}/{n}" for n in names if fs.exists(_fs(spark, f"{root}/{n}/{DONE_MARKER}")[1])]


def _part(df: DataFrame, key: str, part: int, parts: int) -> DataFrame:
    """The rows of ``df`` in one of ``parts`` by a hash of ``key`` (a null has a part, too)."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(parts)) == part) if parts > 1 else df


def _write_kept(old: DataFrame, touched: DataFrame, path: str) -> None:
    """Append to ``path`` the rows of ``old`` without the ids in ``touched`` (one row each).

    The ids go to every task, so that no row of ``old`` is shuffled; ``old`` is read once
    for each ``TOUCHED_IDS`` of them. With more ids than ``PARTS`` readings can
    take, each reading shuffles its part of the rows.
    """
    n = touched.count()
    parts = max(1, min(PARTS, -(-n // incremental.TOUCHED_IDS)))
    for part in range(parts):
        kept = incremental.without_ids(_part(old, "inspection_id", part, parts), _part(touched, "_touched", part, parts), n // parts)
        kept.write.mode("append").options(**COMPACT).parquet(path)


def _write_scores(spark: SparkSession, stored: DataFrame, path: str, as_of, cfg: ScoringConfig) -> None:
    """The scores of ``stored`` inspections; of many, for a part of the establishments at a time."""
    states, parts = staging_path(spark, "states"), incremental.turns_for(stored.count(), PARTS)
    for part in range(parts):
        establishment_state(_part(stored, KEY, part, parts), cfg).write.mode("append").options(**COMPACT).parquet(states)
    clustered_scores(scores_of_state(spark.read.parquet(states), as_of, cfg), path)
    drop_staged(spark, states)


def _refresh(spark: SparkSession, parsed: DataFrame, out_dir: str, as_of, cfg: ScoringConfig, batch_id: int, keep: int) -> None:
    """Merge one batch's parsed records (one per id) into the tables of the newest complete folder before it."""
    target = f"{out_dir.rstrip('/')}/batch={batch_id:010d}"
    before = [d for d in _complete(spark, out_dir) if d < target]
    parsed.select(INSPECTION_COLUMNS).write.mode("overwrite").options(**COMPACT).parquet(f"{target}/inspections")
    if before:
        _write_kept(spark.read.schema(INSPECTIONS).parquet(f"{before[-1]}/inspections"),
                    parsed.select(F.col("inspection_id").alias("_touched")), f"{target}/inspections")
    _write_scores(spark, spark.read.schema(INSPECTIONS).parquet(f"{target}/inspections"), f"{target}/risk_scores", as_of, cfg)
    spark.createDataFrame([(batch_id,)], "batch_id long").write.mode("overwrite").json(f"{target}/{DONE_MARKER}")
    for old_dir in _complete(spark, out_dir)[:-keep]:
        fs, path = _fs(spark, old_dir)
        fs.delete(path, True)


def start_refresh(spark: SparkSession, landing_dir: str, raw_dir: str, out_dir: str, checkpoint_dir: str,
                  as_of, cfg: ScoringConfig = DEFAULT_CONFIG, available_now: bool = True,
                  processing_time: str | None = None, keep: int = KEEP_OUTPUTS, buckets: int | None = None,
                  keep_seconds: float = snapshots.KEEP_SECONDS):
    """Start the refresh query; returns the ``StreamingQuery``.

    ``raw_dir`` receives the landed records (kept for audit, with the file and place
    in it that each came from) under ``_landed`` and the cleaned + parsed rows of every batch under ``_parsed``, each in a
    partition by batch id that a retried batch overwrites. The newest ``keep``
    outputs stay in ``out_dir``. With ``buckets`` (chosen once: inspections'
    bytes over those a refresh may rewrite for one record) ``out_dir`` holds
    snapshots, one per batch, of this checkpoint's stream alone.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    base = raw_dir.rstrip("/")

    def stored(path: str, batch_id: int, *parts: DataFrame) -> DataFrame:
        """``parts`` written to the batch's own folder of ``path`` and read back, under their schema."""
        target = f"{path}/{BATCH}={batch_id}"
        for n, df in enumerate(parts):
            df.write.mode("append" if n else "overwrite").options(**COMPACT).parquet(target)
        return df.sparkSession.read.schema(T.StructType(df.schema.fields)).parquet(target)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        with shuffles_dropped(batch.sparkSession):
            merge(batch, batch_id)

    def merge(batch: DataFrame, batch_id: int) -> None:
        names = page_schema().fieldNames()
        placed = batch.select(*names, _FILE, _BLOCK, F.monotonically_increasing_id().alias(_LINE))
        placed = stored(f"{base}/_landed", batch_id, placed)
        landed = in_landing_order(placed, natural_entries(placed.select(F.col(_FILE).alias("file")).distinct()), names)
        repeated = repeated_ids(usable_records(landed, cfg))
        parts = PARTS if repeated is None else 1              # without them whole records are shuffled
        parsed = stored(f"{base}/_parsed", batch_id, *(
            parse_violations(clean(_part(landed, "inspection_id", n, parts), cfg, repeated), cfg=cfg) for n in range(parts)))
        if repeated is not None:
            drop_staged_frame(repeated)
        if buckets:
            incremental.refresh(batch.sparkSession, parsed, out_dir, as_of, batch_id + 1, buckets, cfg,
                                checkpoint_dir, keep, keep_seconds)
        else:
            _refresh(batch.sparkSession, parsed, out_dir, as_of, cfg, batch_id, keep)

    writer = landing_stream(spark, landing_dir).writeStream.foreachBatch(on_batch) \
        .option("checkpointLocation", checkpoint_dir)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def latest_output(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame] | None:
    """(inspections, risk_scores) of the newest snapshot or complete batch folder, if any."""
    if snapshot := snapshots.current(spark, out_dir):
        return snapshot.read(spark, incremental.TABLE, INSPECTIONS), snapshot.read(spark, incremental.RISK)
    complete = _complete(spark, out_dir)
    if not complete:
        return None
    return (spark.read.parquet(f"{complete[-1]}/inspections"),
            spark.read.parquet(f"{complete[-1]}/risk_scores"))


__all__ = ["landing_stream", "start_refresh", "latest_output"]
