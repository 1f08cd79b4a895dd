"""K8: file layouts that stand in for indexes.

``zordered`` lays a table out along a space-filling curve over several columns,
so that a filter on any one of them meets few files and row groups: the
minimum and maximum that Parquet keeps for each are narrow in every column at
once. ``dated`` does the same for one column. Both may add Bloom filters, by
which the lookup of one value skips every row group that does not hold it.

The curve needs each value's rank among all, to a few bits. Ranks come from
boundaries between equal shares of a bounded sample: a rough boundary makes
files a little uneven and changes no row.

Ranges are found by a pass of their own before the rows are dealt, so both
layouts store the rows first: however dear they are to derive, it happens once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

SAMPLE_ROWS = 10_000      # at most so many values of the curve's columns come to the driver
BITS = 6                  # 64 ranks a column
ROW_GROUP_BYTES = 16 << 20


def boundaries(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """For each column, distinct values that cut the rows in at most ``2 ** bits``
    about equal shares, from the ``SAMPLE_ROWS`` rows of lowest hash over all columns."""
    chance = F.xxhash64(*(F.col(c) for c in df.columns))
    sample = df.select(*columns, chance.alias("_chance")).orderBy("_chance").limit(SAMPLE_ROWS).drop("_chance").collect()
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        at = {values[len(values) * i >> bits] for i in range(1, 1 << bits)} if values else set()
        cuts[c] = sorted(at)
    return cuts


def rank(column: str, cuts: list, bits: int = BITS) -> Column:
    """How many of the boundaries a value has reached, over the whole of ``bits``; nulls come first."""
    if not cuts:
        return F.lit(0).cast("long")
    reached = F.size(F.filter(F.array(*(F.lit(v) for v in cuts)), lambda v: v <= F.col(column)))
    # few boundaries (few distinct values) still use the upper bits, where the curve splits first
    spread = F.coalesce(reached, F.lit(0)) * F.lit((1 << bits) - 1) / F.lit(len(cuts))
    return F.floor(spread).cast("long")


def curve(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """The ranks' bits in turn, highest first (a Z-order value)."""
    if len(ranks) * bits > 62:
        raise ValueError("too many bits for one long")
    z = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for r in ranks:
            z = F.shiftleft(z, 1).bitwiseOR(F.shiftright(r, bit).bitwiseAND(F.lit(1).cast("long")))
    return z


def _write(df: DataFrame, path: str, order: Sequence[Column], n_files: int | None, bloom: dict[str, int], drop: Sequence[str]) -> None:
    """Rows in ranges of ``order``. A range key that runs on to a unique column
    splits a value that holds a large share of the rows over several files."""
    ranged = df.repartitionByRange(n_files, *order) if n_files else df.repartitionByRange(*order)
    out = ranged.sortWithinPartitions(*order).drop(*drop).write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES)
    for column, distinct in bloom.items():
        out = out.option(f"parquet.bloom.filter.enabled#{column}", "true")
        out = out.option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct))
    out.parquet(path)


def zordered(df: DataFrame, path: str, columns: Sequence[str] = ("zip", "dynamic_risk_score"), key: str = "establishment_id",
             n_files: int | None = None, bloom: dict[str, int] | None = None) -> None:
    """``df`` along a curve over ``columns``, then by ``key`` inside a cell of it.

    Among F files a filter on one of k columns meets about F^(1 - 1/k). The key is
    looked up by its Bloom filter instead of taking part in the curve, which
    would cost the other columns a share of theirs. ``bloom`` gives the distinct
    values expected in a row group; by default a filter for 100,000 keys.
    Nulls lie together at the beginning of their column; an empty table is written empty.
    """
    if clash := {"_z"} & set(df.columns):
        raise ValueError(f"column names kept for the layout: {sorted(clash)}")
    df = staged(df, "zordered")
    cuts = boundaries(df, columns)
    z = curve([rank(c, cuts[c]) for c in columns])
    order = [F.col("_z"), *(F.col(c).asc_nulls_first() for c in columns), F.col(key)]
    _write(df.withColumn("_z", z), path, order, n_files, {key: 100_000} if bloom is None else bloom, ["_z"])


DAY = "_day"


def dated(inspections: DataFrame, path: str, date: str = "inspection_date", key: str = "inspection_id",
          n_files: int | None = None, bloom: dict[str, int] | None = None) -> None:
    """``inspections`` in ranges of the date, newest first, with Bloom filters on the
    establishment: a period reads its own files, a history the row groups that hold it.

    Spark pushes no comparison of zone-less timestamps into Parquet, so the day is
    stored beside the date for ``period`` to filter by.
    """
    if DAY in inspections.columns:
        raise ValueError(f"column name kept for the layout: {DAY}")
    order = [F.col(date).desc_nulls_last(), F.col(key)]
    own = inspections.withColumn(DAY, F.col(date).cast("date"))
    _write(staged(own, "dated"), path, order, n_files, {"establishment_id": 100_000} if bloom is None else bloom, [])


def period(stored: DataFrame, first: str, last: str, date: str = "inspection_date") -> DataFrame:
    """Rows of a ``dated`` table from ``first`` to ``last`` (ISO text, inclusive)."""
    ends = [F.lit(d).cast("timestamp_ntz") for d in (first, last)]
    days = F.col(DAY).between(*(e.cast("date") for e in ends))
    return stored.where(days & F.col(date).between(*ends)).drop(DAY)
