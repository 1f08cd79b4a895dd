"""The dashboard's queries as one object over the stored tables.

Every panel is a lazy DataFrame built from the serving operators; nothing is
collected here. The scores are read through the one-hour TTL cache (D19). The panels
that count or average come from a rollup made once per reading of the scores, by one
pass for each selection; the map and the top list read the scores. The
inspections, with their texts, are read from the files by each lookup, which
needs a few columns of a few keys. Where the tables are snapshots, one is held
for the ttl, so both tables are of one refresh and its files stay readable.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators import rollup as RU
from ..operators import search_index as SI
from ..operators import serving as D
from ..sinks import snapshots

INSPECTIONS = "inspections"
SCORES = "risk_scores"


@dataclass
class Filters:
    """Sidebar state: score range (inclusive) and facet selections (empty = all)."""

    lo: float = 0.0
    hi: float = 100.0
    facility_types: Sequence[str] = field(default_factory=tuple)
    zips: Sequence[str] = field(default_factory=tuple)


class Dashboard:
    def __init__(self, spark: SparkSession, tables_dir: str, ttl: float = D.CACHE_TTL_SECONDS):
        self.spark, self.base, self.ttl = spark, tables_dir.rstrip("/"), ttl
        self._held: tuple[float, snapshots.Snapshot | None] | None = None
        self._rollup: tuple[DataFrame, DataFrame] | None = None      # the scores it was made from, the rollup
        self._sums: DataFrame | None = None                          # of the last selection

    def _paths(self, table: str) -> list[str]:
        """Folders of the table in the snapshot held, or its plain folder."""
        if self._held is None or time.monotonic() - self._held[0] >= self.ttl:
            newest = snapshots.current(self.spark, self.base)
            if self._held and self._held[1] and newest != self._held[1]:
                for path in self._held[1].paths(SCORES):
                    D.release_cached(self.spark, path)
            self._held = (time.monotonic(), newest)
        held = self._held[1]
        return held.paths(table) if held else [f"{self.base}/{table}"]

    @property
    def scores(self) -> DataFrame:
        return D.load_cached(self.spark, self._paths(SCORES)[0], ttl=self.ttl)

    def _postings(self) -> DataFrame | None:
        held = self._held[1] if self._held else None
        paths = held.paths(snapshots.POSTINGS) if held else []
        return self.spark.read.parquet(*paths) if paths else None

    @property
    def inspections(self) -> DataFrame:
        paths = self._paths(INSPECTIONS)
        stored = self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schemas.INSPECTIONS)
        return D.inspections_view(stored)

    @property
    def rollup(self) -> DataFrame:
        scores = self.scores
        if self._rollup is None or self._rollup[0] is not scores:
            if self._rollup:
                self._rollup[1].unpersist()
            self._rollup = (scores, RU.score_rollup(scores).cache())
        return self._rollup[1]

    def facets(self) -> DataFrame:
        return D.facets(self.scores)

    def panels(self, f: Filters | None = None, top: int = 20) -> dict[str, DataFrame]:
        """KPIs, map, top-N, histogram, risk by facility type and by ZIP for the filtered set."""
        f = f or Filters()

        def selected(df: DataFrame) -> DataFrame:
            return D.apply_filters(df, f.lo, f.hi, f.facility_types, f.zips)

        if self._sums is not None:
            self._sums.unpersist()       # frames of an earlier selection stay right, they are summed again
        self._sums = RU.panel_sums(selected(self.rollup)).cache()
        rows = selected(self.scores)
        return {"map": D.map_points(rows), "top_n": D.top_n(rows, top), **RU.panels(self._sums)}

    def lookup(self, term: str, k: int = 20, literal: bool = False) -> dict[str, DataFrame]:
        """Search over all establishments; cards, labels and history for the top ``k`` matches.
        Postings in the snapshot held are used, since they are of its scores."""
        scores, stored = self.scores, self._postings()
        matches = (SI.search_top(scores, stored, term, k, literal) if stored is not None
                   else D.search_top(scores, term, k, literal))
        return {
            "matches": matches,
            "labels": D.card_label(matches),
            "cards": D.detail_card(matches),
            "history": D.inspection_history(matches, self.inspections, 10),
        }
