"""Violation-text signal expressions (codes, tiers, keywords, severity).

All of these are native higher-order / regex expressions, evaluated in the JVM
(higher-order functions run interpreted, outside the generated code around
them); none needs a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (CODE_PATTERN, CRITICAL_CODES, DEFAULT_CONFIG, MINOR_CODES,
                      MINOR_EXTRA_CODE, SERIOUS_CODES, ScoringConfig)
from .text import col_


def _in_range(n: Column, bounds: tuple[int, int]) -> Column:
    return n.between(bounds[0], bounds[1])


def violation_codes(text: str | Column) -> Column:
    """All numbered codes (repeats kept, text order), restricted to 1-44 and 70.

    Null text gives an empty array.
    """
    found = F.regexp_extract_all(F.coalesce(col_(text), F.lit("")), F.lit(CODE_PATTERN), 1)
    nums = F.transform(found, lambda s: s.cast("int"))
    return F.filter(nums, lambda n: n.between(1, 44) | (n == MINOR_EXTRA_CODE))


def code_tier_counts(codes: str | Column) -> dict[str, Column]:
    """Number of codes in each tier (critical / serious / minor)."""
    c = col_(codes)
    return {
        "n_critical": F.size(F.filter(c, lambda n: _in_range(n, CRITICAL_CODES))),
        "n_serious": F.size(F.filter(c, lambda n: _in_range(n, SERIOUS_CODES))),
        "n_minor": F.size(F.filter(c, lambda n: _in_range(n, MINOR_CODES) | (n == MINOR_EXTRA_CODE))),
    }


def keyword_pattern(words: list[str]) -> str:
    """Regex that matches, without consuming it, the longest of ``words`` at every place
    where one begins (group 1): the words as a tree of their letters, behind a
    quick look at the first two."""
    def branch(node: dict) -> str:
        ways = [re.escape(c) + branch(after) for c, after in node.items() if c]
        some = ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"
        return "" if not ways else f"(?:{some})?" if "" in node else some

    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}
    begins = "".join(f"[{''.join(re.escape(c) for c in sorted({w[i] for w in words}))}]"
                     for i in range(min(2, min(map(len, words)))))
    return f"(?={begins})(?=({branch(tree)}))"


def lowered_text(text: str | Column) -> Column:
    """Lower-cased text with null as empty: the input of ``keyword_places``."""
    return F.lower(F.coalesce(col_(text), F.lit("")))


def keyword_places(lowered: str | Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """Which keywords an already lower-cased text contains, as sorted places in the tiers' lists laid end to end.

    The text is read once for all keywords: where the longest one begins, so do
    the others that it begins with. Project the result as its own column before
    ``keyword_scan``, which reads it once per tier.
    """
    every = [k for kws in cfg.keyword_tiers.values() for k in kws]
    words = sorted({k for k in every if k})
    always = F.array(*(F.lit(i) for i, k in enumerate(every) if not k)).cast("array<int>")
    if not words:
        return always
    places = F.create_map(*(x for w in words for x in (F.lit(w), F.array(*(F.lit(i) for i, k in enumerate(every) if k and w.startswith(k))))))
    longest = F.array_distinct(F.regexp_extract_all(col_(lowered), F.lit(keyword_pattern(words)), F.lit(1)))
    found = F.flatten(F.transform(longest, lambda w: F.element_at(places, w)))
    return F.sort_array(F.array_distinct(F.concat(always, found)))


def keyword_scan(places: str | Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> dict[str, Column]:
    """Per-tier arrays of the keywords found (in list order), from their ``keyword_places``."""
    out, first = {}, 0
    for tier, kws in cfg.keyword_tiers.items():
        out[tier] = _of_tier(col_(places), first, kws)
        first += len(kws)
    return out


def _of_tier(places: Column, first: int, keywords: list[str]) -> Column:
    words = F.array(*(F.lit(k) for k in keywords)).cast("array<string>")
    own = F.filter(places, lambda i: i.between(first, first + len(keywords) - 1))
    return F.transform(own, lambda i: F.element_at(words, i - F.lit(first - 1)))


def structured_signal(n_critical: Column, n_serious: Column, n_minor: Column,
                      cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    w = cfg.code_weights
    return n_critical * w["critical"] + n_serious * w["serious"] + n_minor * w["minor"]


def keyword_signal(kw_critical: Column, kw_major: Column, kw_minor: Column,
                   cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    w = cfg.keyword_weights
    return kw_critical * w["critical"] + kw_major * w["major"] + kw_minor * w["minor"]


def severity(structured: Column, keyword: Column, cfg: ScoringConfig = DEFAULT_CONFIG) -> Column:
    """0-100 soft-capped severity: round(min(100*(1-e^(-raw/10)), 100), 2)."""
    raw = (structured + keyword) / F.lit(2.0)
    curve = F.lit(100.0) * (F.lit(1.0) - F.exp(-raw / F.lit(cfg.severity_scale)))
    return F.round(F.least(curve, F.lit(100.0)), 2)
