"""Order-dependent positions computed without a single-task window.

``global_row_index`` numbers rows under a total order across the whole
dataset: range-partitioned sort, per-partition counts (one row per partition),
prefix offsets joined back. ``rank_within_key`` gives each row its 1-based
position inside its key through that index, so a key with a third of all rows
is spread like any other and the plan is the same at every size. Pass only the
columns that are needed: they are sorted and written once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

_LOW_BITS = (1 << 33) - 1   # monotonically_increasing_id = partition id << 33 | row index


def global_row_index(df: DataFrame, order: Sequence[Column], name: str = "row_index") -> DataFrame:
    """Add a 0-based ``name`` consecutive in ``order`` (which must be total).

    The sorted, id-tagged rows are written to the shared folder first: the
    boundaries of a range sort are sampled, so the count pass and the tagging
    pass must read one and the same sorting, also after a lost executor.
    """
    tagged = staged(df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id()), "row-index")
    part = F.shiftright(F.col("_mid"), 33)
    sizes = tagged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: bounded by the number of tasks, so this window is safe.
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_offset"))
    return (tagged.withColumn("_part", part)
            .join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)))
            .drop("_mid", "_part", "_offset"))


def rank_within_key(df: DataFrame, key: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position of each row within ``key`` under ``order`` (total per key)."""
    indexed = global_row_index(df, [F.col(key).asc_nulls_first(), *order], "_g")
    first = indexed.groupBy(F.col(key).alias("_key")).agg(F.min("_g").alias("_g0"))   # one row per key, partial per task
    return (indexed.join(first, F.col(key).eqNullSafe(F.col("_key")))
            .select(*df.columns, (F.col("_g") - F.col("_g0") + 1).cast("int").alias(name)))
