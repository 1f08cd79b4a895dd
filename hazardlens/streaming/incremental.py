"""Refresh that rewrites only what a batch touches.

Inspections lie in folders by a hash of their establishment, and beside each
lies the clock-free state of its establishments: counts, exact sums, last
failure, the trend window's mean and the latest row. A batch of corrected or new
records

1. finds where its ids lie now, from two narrow columns of the stored table;
2. rewrites the buckets that hold these ids or the new records' establishments —
   so a correction takes its old record out of whatever establishment had it;
3. recomputes the state of these buckets from their inspections, as a last
   failure or a newest row can't be taken back by subtraction;
4. scores all establishments from their states, one row each: recency moves with
   the clock, but no inspection is read for it.

Buckets that the batch does not touch keep their files, named again by the next
commit (``sinks/snapshots``). A large establishment is written by many tasks:
rows are dealt by the rebalancing exchange, which splits large buckets. A large
batch rewrites its buckets in up to ``TURNS`` turns, so that only the rows of one
are in shuffle files; the rows that stay are not shuffled by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoringConfig
from ..operators.scoring import KEY, establishment_state, scores_of_state
from ..schemas import INSPECTION_COLUMNS, INSPECTIONS, SCORES
from ..session import COMPACT, drop_staged_frame, staged
from ..sinks import snapshots
from ..sinks.writers import clustered_scores

TABLE, STATE, RISK = "inspections", "state", "risk_scores"
BUCKET, ID = "bucket", "inspection_id"
TURNS = 8                     # turns in which a large batch rewrites its buckets, at most
TURN_ROWS = 400_000           # rows that a turn may have before there are more (about 90 MB in shuffle files)
TOUCHED_IDS = 500_000         # touched ids that are sent to every task at once (about 50 MB)


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def turns_for(rows: int, most: int) -> int:
    return max(1, min(most, -(-rows // TURN_ROWS)))


def without_ids(old: DataFrame, touched: DataFrame, n: int) -> DataFrame:
    """The rows of ``old`` whose id is not among the ``n`` rows of ``touched``; null is an id."""
    gone = F.broadcast(touched) if n <= TOUCHED_IDS else touched
    return old.join(gone, F.col(ID).eqNullSafe(F.col("_touched")), "left_anti")


def _write(df: DataFrame, path: str, buckets: int) -> None:
    """Append ``df`` to one folder per bucket below ``path``."""
    (df.withColumn(BUCKET, bucket_of(buckets)).hint("rebalance", F.col(BUCKET))
     .write.mode("append").options(**COMPACT).partitionBy(BUCKET).parquet(path))


def _counts(df: DataFrame) -> dict[int, int]:
    """Rows by bucket: as many numbers as there are buckets at most."""
    return {r[BUCKET]: r["n"] for r in df.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()}


def _folders(spark: SparkSession, base: str, where: str, numbers: list[int]) -> list[str]:
    """Those of the buckets ``numbers`` that have rows below ``where``."""
    found = (f"{where}/{n}" for n in snapshots.children(spark, f"{base}/{where}") if n.startswith(f"{BUCKET}="))
    return [f for f in found if _number(f) in numbers]


def refresh(spark: SparkSession, parsed: DataFrame, base: str, as_of, version: int, buckets: int,
            cfg: ScoringConfig = DEFAULT_CONFIG, writer: str = "", keep: int = snapshots.KEEP,
            keep_seconds: float = snapshots.KEEP_SECONDS) -> snapshots.Snapshot:
    """Merge parsed records (one per id) into the tables under ``base`` as snapshot ``version``.

    A version that this ``writer`` has committed is left as it is: a retried
    batch has the same records. ``buckets`` is a property of the tables and
    can't change. An empty batch scores anew with the clock. A null id counts
    as one id.
    """
    base = base.rstrip("/")
    found = snapshots.versions(spark, base)
    if found and version <= found[-1]:
        done = snapshots.load(spark, base, version) if version in found else None
        if done is None or done.properties.get("writer") != writer:
            raise ValueError(f"{base} has version {found[-1]} of another writer or a later one")
        return done
    before = snapshots.current(spark, base)
    if before and before.properties.get("buckets") != buckets:
        raise ValueError(f"{base} has {before.properties.get('buckets')} buckets, not {buckets}")
    fresh = parsed.select(INSPECTION_COLUMNS)
    rows = _counts(fresh.select(bucket_of(buckets).alias(BUCKET)))
    lie: dict[int, int] = {}
    if before:
        ids = parsed.select(F.col(ID).alias("_touched")).distinct()
        stored = before.read(spark, TABLE, INSPECTIONS).select(ID, bucket_of(buckets).alias(BUCKET))
        located = staged(stored.join(ids, F.col(ID).eqNullSafe(F.col("_touched")), "left_semi"), "located")
        lie = _counts(located)
    touched = sorted({*rows, *lie})
    kept = {t: [f for f in before.tables[t] if _number(f) not in touched] if before else [] for t in (TABLE, STATE)}
    rewritten = [p for p in before.paths(TABLE) if _number(p) in touched] if before else []
    size = sum(rows.values()) + (spark.read.schema(INSPECTIONS).parquet(*rewritten).count() if rewritten else 0)
    written: dict[str, list[str]] = {TABLE: [], STATE: []}
    where = {t: snapshots.folder(t, version, "batch") for t in (TABLE, STATE)}
    for t in where:
        snapshots.remove(spark, f"{base}/{where[t]}")         # of a batch that failed
    some = max(1, -(-len(touched) // turns_for(size, TURNS)))
    for turn in (touched[i:i + some] for i in range(0, len(touched), some)):
        merged = fresh if turn == touched else fresh.where(bucket_of(buckets).isin(turn))
        paths = [p for p in rewritten if _number(p) in turn]
        if paths:
            gone = located.where(F.col(BUCKET).isin(turn)).select(F.col(ID).alias("_touched")).distinct()
            old = spark.read.schema(INSPECTIONS).parquet(*paths)
            merged = without_ids(old, gone, sum(lie.get(b, 0) for b in turn)).unionByName(merged)
        _write(merged, f"{base}/{where[TABLE]}", buckets)
        folders = _folders(spark, base, where[TABLE], turn)
        if folders:
            own = spark.read.schema(INSPECTIONS).parquet(*[f"{base}/{f}" for f in folders])
            _write(establishment_state(own, cfg), f"{base}/{where[STATE]}", buckets)
        written[TABLE] += folders
        written[STATE] += _folders(spark, base, where[STATE], turn)
    if before:
        drop_staged_frame(located)
    tables = {t: kept[t] + written[t] for t in (TABLE, STATE)}
    tables[RISK] = [snapshots.folder(RISK, version, "batch")]
    if tables[STATE]:
        states = spark.read.parquet(*[f"{base}/{f}" for f in tables[STATE]])
        scores = scores_of_state(states, as_of, cfg)
    else:
        scores = spark.createDataFrame([], SCORES)
    clustered_scores(scores, f"{base}/{tables[RISK][0]}")
    made = snapshots.commit(spark, base, version, tables, buckets=buckets, writer=writer)
    snapshots.prune(spark, base, keep, keep_seconds)
    return made
