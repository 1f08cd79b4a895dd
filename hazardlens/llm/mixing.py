"""Mixing sources to target weights by systematic sampling, in DataFrame functions only.

Within a source every document has the same expected number of copies (the
source's target over its size). Documents are put in one fixed order, the
expected copies are prefix-summed, one random offset is added, and a document
is emitted once for every integer that its stretch of the sum crosses.

The order within a source is by blocks: size band, then a hash of the row. As
sizes rise along it, the sample is spread evenly over sizes and a source's
taken words come near its target. The prefix sum is taken on three levels —
bands within a source, blocks within a band, documents within a block — so
that a source with a third of all rows is shared out over its blocks. Since
the expectation is constant within a source, the prefix sum is a rank (an exact
integer) times that constant, and reruns agree.

The block totals are written to the shared folder, so words are counted twice in
all: for the totals and for the rows. Only per-source totals meet in one task:
one small row per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import staged
from .columns import unused

WEIGHTS = (1, 2, 3)       # by code point order of the sources, repeating
MAX_REPEAT = 3            # a target is at most so many times its source's size
BLOCKS = 64               # blocks of a size band
BANDS_PER_OCTAVE = 4


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``sizes(source, size)`` -> ``source, source_size, target``, one row per source.

    Sources in code point order, null last, take ``weights`` in turn and share
    all of the sizes; a share above ``max_repeat`` times its source's size is
    cut to that, and the excess goes to the others by weight until none is
    above. That end state is one level ``x`` with target = least(weight * x,
    cap): in order of cap / weight, the first source whose cap is not below
    its weight's part of what the sources before it leave sets the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.array(*(F.lit(float(w)) for w in weights))
    per = per.withColumn("weight", F.element_at(turn, (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", F.col("source_size") * float(max_repeat))
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total, mass = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    level = ((total - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             / (mass - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    per = per.withColumn("level", level)
    fits = F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("level"))
    per = per.withColumn("level", F.max(fits).over(everything))
    return per.select("source", "source_size",
                      F.least(F.col("cap"), F.coalesce(F.col("weight") * F.col("level"), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = 7,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        names: tuple[str, str, str, str] = ("size", "source_size", "target", "copies")) -> DataFrame:
    """``docs`` with its size in words, its source's size and target, and the
    number of copies the mix takes (0 to ``ceil(max_repeat)``), under ``names``.

    Null text has size 0. Rows with a null source are one source, the last.
    Rows of a source without words get target 0 and no copies. Rows equal in
    id, text and source are interchangeable: each counts, and any of them may
    be the one taken. Rows with null ids are placed by their text. The new
    names must be free in ``docs`` (in any case); otherwise extra columns pass
    through untouched. An empty table gives no rows.
    """
    if len({n.lower() for n in (*docs.columns, *names)}) < len(docs.columns) + len(names):
        raise ValueError(f"columns {names} must be unused")
    size, source_size, target, copies = names
    band, block, place, first, key, rank = unused(docs, "mix_band", "mix_block", "mix_place", "mix_first", "mix_key", "mix_rank")
    # a key that is never null and sorts as the sources do, null last
    keyed = F.when(docs[source_col].isNull(), F.lit("b")).otherwise(F.concat(F.lit("a"), docs[source_col].cast("string")))
    mark = F.xxhash64(F.lit(seed), docs[id_col], docs[text_col])
    sized = docs.withColumns({size: word_count(docs[text_col]), key: keyed, place: mark})
    octave = F.log2(F.greatest(F.col(size), F.lit(1)).cast("double"))
    sized = sized.withColumns({band: F.floor(octave * BANDS_PER_OCTAVE).cast("int"),
                               block: F.pmod(F.col(place), F.lit(BLOCKS)).cast("int")})

    # the one pass that counts words before the final one; all totals come from its small result
    counts = staged(sized.groupBy(key, band, block).agg(
        F.count("*").alias("n"), F.sum(size).alias("size")), "mix")
    targets = source_targets(counts.select(F.col(key).alias("source"), "size"), weights, max_repeat)
    bands = counts.groupBy(key, band).agg(F.sum("n").alias("n"))
    in_source = W.partitionBy(key).orderBy(band).rowsBetween(W.unboundedPreceding, -1)
    bands = bands.select(key, band, F.coalesce(F.sum("n").over(in_source), F.lit(0)).alias("band_first"))
    in_band = W.partitionBy(key, band).orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    blocks = counts.select(key, band, block, F.coalesce(F.sum("n").over(in_band), F.lit(0)).alias("block_first"))
    blocks = (blocks.join(bands, [key, band])
              .join(targets.select(F.col("source").alias(key), F.col("source_size").alias(source_size),
                                   F.col("target").alias(target)), key)
              .select(key, band, block, source_size, target, (F.col("band_first") + F.col("block_first")).alias(first)))

    in_block = W.partitionBy(key, band, block).orderBy(size, place, F.col(id_col).asc_nulls_last())
    ranked = sized.withColumn(rank, F.row_number().over(in_block) - 1).join(blocks, [key, band, block])
    at = F.col(first) + F.col(rank)
    # a rate of exactly max_repeat crosses max_repeat integers at every step
    rate = F.when(F.col(source_size) > 0, F.least(F.col(target) / F.col(source_size), F.lit(float(max_repeat)))).otherwise(0.0)
    offset = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 32)) / float(1 << 32)
    taken = F.floor((at + 1) * rate + offset) - F.floor(at * rate + offset)
    return ranked.select(*(docs[c] for c in docs.columns), size, source_size, target,
                         F.when(F.col(source_size) > 0, taken).otherwise(0).cast("long").alias(copies))


def emit(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it."""
    names = unused(docs, "size", "source_size", "target", "copies")
    copies = names[3]
    many = mix(docs, names=tuple(names), **options).where(F.col(copies) > 0)
    one, = unused(docs, "mix_copy")
    return many.withColumn(one, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)
