"""Small helpers for operators that take a caller's whole rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROWS = 1024           # rows whose Python values a worker holds at a time


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (in any case)."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in have:
            name += "_"
        have.add(name.lower())
        out.append(name)
    return out


def sliced(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, without a copy. What a map
    makes of a batch (values, then a result) is so many times its size that a
    worker's memory follows this number, not Spark's batches."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
