"""D9 by trigrams: a posting table over name, alias and address.

``postings`` holds one row per three-letter sequence of an establishment's
lower-cased texts, stored in the order of the sequences. A search takes the
letters that any match must contain (``required_text``), reads the postings of
their rarest sequences, and tests the term itself on those rows only. A term
without such letters is tested on every row, as in ``serving.search``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import serving as D

SEARCHED = ("dba_name", "aka_name", "address")
GRAM = 3
RAREST = 4            # sequences looked up per search
MAX_SHARE = 0.1       # beyond this share of all rows the postings save nothing: every row is tested


def _grams(text: Column) -> Column:
    n = F.length(text)
    starts = F.when(n >= GRAM, F.sequence(F.lit(1), n - GRAM + 1)).otherwise(F.array().cast("array<int>"))
    return F.coalesce(F.transform(starts, lambda i: F.substring(text, i, F.lit(GRAM))), F.array().cast("array<string>"))


def postings(scores: DataFrame, columns: Sequence[str] = SEARCHED) -> DataFrame:
    """``gram, establishment_id``, one row each; null and shorter texts add none."""
    grams = F.array_distinct(F.flatten(F.array(*(_grams(F.lower(c)) for c in columns))))
    return scores.select(F.explode(grams).alias("gram"), D.KEY)


def store_postings(scores: DataFrame, path: str, n_files: int | None = None) -> None:
    """The postings in ranges of the sequence; one that very many rows share runs over several files."""
    order = ["gram", D.KEY]
    found = postings(scores)
    ranged = found.repartitionByRange(n_files, *order) if n_files else found.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def required_text(term: str, literal: bool = False) -> list[str]:
    """Pieces that every text matched by ``term`` contains.

    Only what is certain counts in a regular expression: plain letters before the
    first group or class that no quantifier follows. Alternatives anywhere, flags,
    quoting and escapes by code give none.
    """
    if literal:
        return [term]
    if "|" in term or "(?" in term:
        return []
    pieces, piece, i = [], "", 0

    def close() -> None:
        nonlocal piece
        pieces.append(piece)
        piece = ""

    while i < len(term):
        c, i = term[i], i + 1
        if c in "([":
            break
        if c == "\\":
            escaped = term[i:i + 1]
            if not escaped or escaped.isalnum() and escaped not in "dDsSwWbBAZz":
                return []
            c, i = "" if escaped.isalnum() else escaped, i + 1
        elif c in ".^$)":
            c = ""
        if term[i:i + 1] in ("*", "+", "?", "{"):
            # this letter may be missing or repeated; what the quantifier says is skipped with it
            close()
            if term[i] == "{":
                end = term.find("}", i)
                if end < 0:
                    return []
                i = end
            i += 1
            while term[i:i + 1] in ("?", "+"):
                i += 1
        elif c:
            piece += c
        else:
            close()
    close()
    return [p for p in pieces if p]


def term_grams(term: str, literal: bool = False) -> list[str]:
    """The three-letter sequences of the required pieces."""
    found = {p[i:i + GRAM] for p in required_text(term.lower(), literal) for i in range(len(p) - GRAM + 1)}
    return sorted(found)


def candidates(stored: DataFrame, grams: Sequence[str]) -> DataFrame:
    """Keys of the rows that hold every one of the sequences."""
    held = stored.where(F.col("gram").isin(list(grams))).groupBy(D.KEY).agg(F.count(F.lit(1)).alias("_held"))
    return held.where(F.col("_held") == len(grams)).select(D.KEY)


def search(scores: DataFrame, stored: DataFrame, term: str, literal: bool = False) -> DataFrame:
    """D9 through the postings ``stored``; the same rows as ``serving.search``.

    One small job counts the postings of the term's sequences (one row per
    sequence). A sequence nobody holds ends the search.
    """
    grams = term_grams(term, literal)
    if not grams:
        return D.search(scores, term, literal)
    counted = {r.gram: r["count"] for r in stored.where(F.col("gram").isin(grams)).groupBy("gram").count().collect()}
    rarest = sorted(grams, key=lambda g: (counted.get(g, 0), g))[:RAREST]
    if counted.get(rarest[0], 0) > MAX_SHARE * scores.count():
        return D.search(scores, term, literal)
    key = candidates(stored, rarest).withColumnRenamed(D.KEY, "_key")
    return D.search(scores.join(key, F.col(D.KEY).eqNullSafe(F.col("_key")), "left_semi"), term, literal)


def search_top(scores: DataFrame, stored: DataFrame, term: str, k: int = 20, literal: bool = False) -> DataFrame:
    """D10 through the postings."""
    return search(scores, stored, term, literal).orderBy(*D.by_score_desc()).limit(k)
