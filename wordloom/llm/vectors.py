"""Vector columns: which rows are usable, and their entries as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds neither nulls nor NaN nor infinities."""
    most = F.lit(1.7976931348623157e308)

    def usable(entry):
        return F.coalesce(~F.isnan(entry) & (F.abs(entry) <= most), F.lit(False))

    entries = F.col(vector).cast("array<double>")
    return df.filter(F.col(vector).isNotNull() & F.forall(entries, usable))


def on_grid(vector: str, scale: int) -> Column:
    """floor(scale * entry) of every entry, taken as double."""
    entries = F.col(vector).cast("array<double>")
    return F.transform(entries, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))


def padded(vector: str, d: int) -> Column:
    """The vector with zeros at its end up to `d` entries."""
    zeros = F.array_repeat(F.lit(0).cast("bigint"), F.lit(d) - F.size(vector))
    return F.concat(F.col(vector), zeros)


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of whole numbers; shorter ones end in zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    d = int(sizes.max()) if len(sizes) else 0
    if (sizes == d).all():
        return flat.reshape(len(sizes), d)
    out = np.zeros((len(sizes), d), np.int64)
    out[np.arange(d) < sizes[:, None]] = flat
    return out


def stacked(batches, rows: int):
    """(ids, vectors) of a partition's rows (id, x) or (x) in blocks of `rows`; the last may be
    smaller."""
    ids, parts, held = [], [], 0

    def joined():
        d = max(p.shape[1] for p in parts)
        wide = [np.pad(p, ((0, 0), (0, d - p.shape[1]))) for p in parts]
        return np.concatenate(ids), np.concatenate(wide)

    for batch in batches:
        vectors = matrix(batch.column("x"))
        names = np.zeros(len(vectors), np.int64)
        if "id" in batch.schema.names:
            names = batch.column("id").to_numpy(zero_copy_only=False)
        at = 0
        while at < len(names):
            take = min(rows - held, len(names) - at)
            ids.append(names[at : at + take])
            parts.append(vectors[at : at + take])
            held, at = held + take, at + take
            if held == rows:
                yield joined()
                ids, parts, held = [], [], 0
    if held:
        yield joined()
