"""Documents as compressed chunks, for operators that pass twice over whole texts.

A scan task packs its rows, in place and in order, into chunks of bounded text
volume: one row each, an Arrow stream under zstd. Chunks are dealt by number,
so equal rows are neither gathered in one task nor sent one by one, and the
exchange of the texts is well below the input's size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

CHUNK_BYTES = 12 << 20        # text in a chunk; a longer document is a chunk of its own
_CHUNKS_OF_TASK = 1 << 24


def pack_table(table: pa.Table, level: int = 1) -> bytes:
    sink, codec = pa.BufferOutputStream(), pa.Codec("zstd", compression_level=level)
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def unpack_table(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def _slices(batches, size: int):
    """Tables of at most ``size`` bytes of text, or of one row."""
    held, room = [], size
    for b in batches:
        lengths = np.asarray(pc.fill_null(pc.binary_length(b.column("text")), 0).cast(pa.int64()))
        start = 0
        for i, n in enumerate(lengths.tolist()):
            if n > room and (held or i > start):
                yield pa.Table.from_batches([*held, b.slice(start, i - start)])
                held, room, start = [], size, i
            room -= n
        if start < b.num_rows:
            held.append(b.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def chunked(src: DataFrame, columns: str, pack=None, size: int | None = None) -> DataFrame:
    """One row per chunk of ``src``, which has the column ``text``.

    ``pack(table)`` gives the values of ``columns`` (a DDL list after ``chunk
    long``) for the rows of a chunk; without it the one column is the packed rows.
    A chunk's number is that of its scan task and its place there.
    """
    names = ["chunk", *(c.split()[0] for c in columns.split(", "))]
    kinds = {"binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    types = [pa.int64(), *(kinds[c.split()[1]] for c in columns.split(", "))]

    size = size or CHUNK_BYTES

    def cut(batches):
        first = TaskContext.get().partitionId() * _CHUNKS_OF_TASK
        for i, table in enumerate(_slices(batches, size)):
            values = (first + i, *(pack(table) if pack else (pack_table(table),)))
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    return src.mapInArrow(cut, f"chunk long, {columns}")
