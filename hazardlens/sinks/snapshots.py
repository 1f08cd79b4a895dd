"""Snapshots: the tables of one refresh behind one commit file.

``base/_commits/0000000003.json`` names the folders of every table of version 3.
A refresh writes new folders, checks them, and then places its commit file; the
highest commit is the current snapshot. Folders are never changed or renamed, so

* a reader has both tables of one refresh, and there is no moment without a table;
* a reader that began before a refresh finishes on the files it began with, and
  a cached frame whose blocks are lost reads them again;
* a failed refresh leaves no commit, and a refresh that lost against another
  writer of the same version is refused.

Superseded snapshots go when they are beyond the newest ``keep`` and were
superseded more than ``keep_seconds`` ago. A commit may name folders of earlier
versions, so a refresh need not rewrite what it does not change.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass
from itertools import takewhile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.search_index import store_postings
from ..schemas import to_sink_schema
from .writers import inspections_for_load, require_key, scores_for_load

COMMITS = "_commits"
KEEP, KEEP_SECONDS = 2, 7200
POSTINGS = "search_postings"


@dataclass(frozen=True)
class Snapshot:
    base: str
    version: int
    tables: dict[str, list[str]]      # table -> its folders below base
    made_at: float                    # seconds since 1970
    properties: dict

    def paths(self, table: str) -> list[str]:
        return [f"{self.base}/{f}" for f in self.tables.get(table, [])]

    def read(self, spark: SparkSession, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The table's rows; without folders an empty frame of ``schema``."""
        folders = self.paths(table)
        if not folders:
            return spark.createDataFrame([], schema or T.StructType([]))
        return (spark.read.schema(schema) if schema else spark.read).parquet(*folders)


def _fs(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path
    return place(path).getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, place = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place(path))) if fs.exists(place(path)) else []


def remove(spark: SparkSession, path: str) -> None:
    """A folder that no snapshot names; nothing if there is none."""
    fs, place = _fs(spark, path)
    fs.delete(place(path), True)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions, oldest first."""
    names = children(spark, f"{base.rstrip('/')}/{COMMITS}")
    return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit()]


def _commit_path(base: str, version: int) -> str:
    return f"{base.rstrip('/')}/{COMMITS}/{version:010d}.json"


def load(spark: SparkSession, base: str, version: int) -> Snapshot:
    path = _commit_path(base, version)
    fs, place = _fs(spark, path)
    stream = fs.open(place(path))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    got = json.loads(text)
    return Snapshot(base.rstrip("/"), version, got["tables"], got["made_at"], got["properties"])


def current(spark: SparkSession, base: str, before: int | None = None) -> Snapshot | None:
    """The newest snapshot (older than version ``before``), if there is one."""
    found = [v for v in versions(spark, base) if before is None or v < before]
    return load(spark, base, found[-1]) if found else None


def commit(spark: SparkSession, base: str, version: int, tables: dict[str, list[str]], **properties) -> Snapshot:
    """Make the folders ``tables`` (below ``base``) the snapshot ``version``; refused if that version exists."""
    base, path = base.rstrip("/"), _commit_path(base, version)
    fs, place = _fs(spark, path)
    snapshot = Snapshot(base, version, tables, time.time(), properties)
    fresh = f"{base}/{COMMITS}/.{version:010d}-{uuid.uuid4().hex[:8]}"
    out = fs.create(place(fresh), False)
    try:
        out.write(json.dumps({"tables": tables, "made_at": snapshot.made_at, "properties": properties}).encode())
    finally:
        out.close()
    try:
        if fs.exists(place(path)) or not fs.rename(place(fresh), place(path)):
            raise FileExistsError(f"version {version} of {base} is committed already")
    finally:
        if fs.exists(place(fresh)):
            fs.delete(place(fresh), False)
    return snapshot


def folder(table: str, version: int, token: str) -> str:
    """Where a refresh writes a table; the token keeps apart writers that aim at one version."""
    return f"{table}/v={version:010d}-{token}"


def prune(spark: SparkSession, base: str, keep: int = KEEP, keep_seconds: float = KEEP_SECONDS) -> None:
    """Remove superseded snapshots, and the folders below their versions that no kept snapshot names."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    base = base.rstrip("/")
    fs, place = _fs(spark, base)
    every = [load(spark, base, v) for v in versions(spark, base)]
    latest = time.time() - keep_seconds
    # a snapshot is superseded when the next one is made
    stale = [old for old, _ in takewhile(lambda two: two[1].made_at <= latest, zip(every, every[1:]))][:max(0, len(every) - keep)]
    kept = every[len(stale):]
    if not stale:
        return
    for old in stale:
        fs.delete(place(_commit_path(base, old.version)), False)
    named = {f for s in kept for folders in s.tables.values() for f in folders}
    for table in {t for s in every for t in s.tables}:
        for name in children(spark, f"{base}/{table}"):
            if not name.startswith("v=") or int(name[2:12]) >= kept[0].version or f"{table}/{name}" in named:
                continue
            inside = [f"{table}/{name}/{n}" for n in children(spark, f"{base}/{table}/{name}")]
            if not named.intersection(inside):
                fs.delete(place(f"{base}/{table}/{name}"), True)
                continue
            for part in inside:
                if "=" in part.rsplit("/", 1)[1] and part not in named:
                    fs.delete(place(f"{base}/{part}"), True)


def publish(inspections: DataFrame, scores: DataFrame, base: str, keep: int = KEEP,
            keep_seconds: float = KEEP_SECONDS, search_index: bool = False) -> Snapshot:
    """K4 as a snapshot: both tables with the sink types, key-checked (K7), then committed together,
    with ``search_index`` also the postings of the scores' texts (D9)."""
    spark, base = inspections.sparkSession, base.rstrip("/")
    version, token = max(versions(spark, base), default=0) + 1, uuid.uuid4().hex[:8]
    tables = {}
    try:
        for df, key, name in ((inspections_for_load(inspections), "inspection_id", "inspections"),
                              (scores_for_load(scores), "establishment_id", "risk_scores")):
            tables[name] = [folder(name, version, token)]
            path = f"{base}/{tables[name][0]}"
            to_sink_schema(df).write.parquet(path)
            require_key(spark.read.parquet(path), key, name)
        if search_index:
            scored = f"{base}/{tables['risk_scores'][0]}"
            tables[POSTINGS] = [folder(POSTINGS, version, token)]
            store_postings(spark.read.parquet(scored), f"{base}/{tables[POSTINGS][0]}")
        made = commit(spark, base, version, tables)
    except Exception:
        fs, place = _fs(spark, base)
        for folders in tables.values():
            fs.delete(place(f"{base}/{folders[0]}"), True)
        raise
    prune(spark, base, keep, keep_seconds)
    return made
