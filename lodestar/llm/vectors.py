"""Vector columns: which rows take part, and their bytes for numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec_id: str, embedding: str) -> Column:
    """Rows with an id and a vector whose components are all present and finite."""
    ok = F.forall(F.col(embedding), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    return F.col(vec_id).isNotNull() & F.coalesce(ok, F.lit(False))


def dimension(rows: DataFrame, embedding: str) -> int:
    """Length of the longest vector; shorter ones count as padded with zeros."""
    return rows.agg(F.max(F.size(embedding))).first()[0] or 0


def matrix(column: pa.Array, width: int, kind=np.float64) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width), kind)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def from_bytes(column: pa.Array, kind, width: int) -> np.ndarray:
    """Rows of a binary column, each ``width`` values of ``kind``."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), width)


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables that hold whole runs of equal ``key`` values of a stream sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(keys == keys[-1])[0])  # the last run may go on in the next batch
        if cut == 0 and held and held[-1].column(key)[-1].as_py() == keys[-1]:
            held.append(batch)
            continue
        ready = [*held, batch.slice(0, cut)]
        if any(b.num_rows for b in ready):
            yield pa.Table.from_batches(ready)
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """One table per run of equal ``key`` values of a stream sorted by it."""
    for table in runs(batches, key):
        keys = table[key].to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            yield table.slice(a, b - a)
