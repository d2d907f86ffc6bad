"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to cells of about equally many rows, the cells give an index on the curve, and runs of the
rows in curve order become shards. Neighbours on the curve are near in every dimension, so a shard spans few values of
each, and minima and maxima per file let readers skip most files for a filter on any of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .staging import hold, positions

#: Bits per dimension; a curve index has this many times the dimensions, 62 at most.
BITS = 5
#: Bytes of a string that order it, after the prefix that all values share.
_BYTES = 7


def curve_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits``-bit coordinates, a row each (Skilling's transform)."""
    x = [c.astype(np.int64) for c in cells.T]
    d = len(x)
    for bit in range(bits - 1, 0, -1):
        q, low = 1 << bit, (1 << bit) - 1
        for i in range(d):
            turned = (x[i] & q) != 0
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[i] = x[i] ^ swap
            x[0] = x[0] ^ np.where(turned, low, swap if i else 0)
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    flip = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    out = np.zeros(len(cells), np.int64)
    for bit in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | (((x[i] ^ flip) >> bit) & 1)
    return out


@dataclass
class Dimension:
    """A column as an order-preserving whole number, null lowest."""

    name: str
    value: Column


def _code(c: Column, prefix: str) -> Column:
    """The first bytes of a string behind a shared prefix, as a number."""
    rest = F.substring(c.cast("binary"), len(prefix.encode()) + 1, _BYTES)
    return F.conv(F.rpad(F.hex(rest), 2 * _BYTES, "0"), 16, 10).cast("long")


def dimensions(docs: DataFrame, names: list[str]) -> list[Dimension]:
    """The columns ``names``; strings are ordered by the bytes after the prefix that all of them share."""
    kinds = {f.name: f.dataType for f in docs.schema}
    strings = [n for n in names if isinstance(kinds[n], StringType)]
    ends = docs.agg(*[f(F.col(f"`{n}`")) for n in strings for f in (F.min, F.max)]).first() if strings else ()
    shared = {}
    for k, n in enumerate(strings):
        lo, hi = ends[2 * k] or "", ends[2 * k + 1] or ""
        same = 0
        while same < min(len(lo), len(hi)) and lo[same] == hi[same]:
            same += 1
        shared[n] = lo[:same]
    none = F.lit(-(1 << 62))
    return [Dimension(n, F.coalesce(_code(F.col(f"`{n}`"), shared[n]) if n in shared else F.col(f"`{n}`").cast("long"), none)) for n in names]


def _curve(bounds: list[list[int]], bits: int):
    edges = [np.array(b, np.int64) for b in bounds]

    def run(batches):
        for b in batches:
            cells = np.column_stack([np.searchsorted(e, b.column(f"v{k}").to_numpy(), side="right") for k, e in enumerate(edges)])
            rest = [c for c in b.schema.names if c not in {f"v{k}" for k in range(len(edges))}]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in rest], pa.array(curve_index(cells, bits))], names=[*rest, "curve"])
    return run


def shard(
    docs: DataFrame, shards: int, names: tuple[str, ...] = ("source", "lang", "size", "doc_id"),
    id_col: str = "doc_id", text_col: str = "text", bits: int = BITS,
) -> DataFrame:
    """Per row of ``docs``: ``id, size, text_crc32, curve, shard, slot``.

    ``size`` is the UTF-8 length of the text plus 8, 0 plus 8 for null; ``names`` are the dimensions, ``size`` among them
    if wanted. Rows are ordered by curve index, id, size and checksum, and cut into ``shards`` runs whose row counts are at
    most one apart; ``slot`` is the place in the run. Nulls of a dimension have its lowest cell, null ids come first.
    Repeated rows stand next to each other. With fewer rows than shards some shards are empty.
    """
    if bits * len(names) > 62:
        raise ValueError("more than 62 bits on the curve")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))
    columns = {n: F.col(f"`{n}`") for n in names if n != "size"}
    rows = hold(docs.select(
        F.col(f"`{id_col}`").cast("long").alias("_id"), (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"), *[c.alias(f"d_{n}") for n, c in columns.items()]), "hilbert-rows")
    dims = dimensions(rows, ["size" if n == "size" else f"d_{n}" for n in names])
    valued = rows.select(F.col("_id").alias("id"), "size", "text_crc32", *[d.value.alias(f"v{k}") for k, d in enumerate(dims)])
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = valued.agg(F.count(F.lit(1)), *[F.percentile_approx(f"v{k}", shares, 10_000) for k in range(len(dims))]).first()
    n, bounds = found[0], [list(b or []) for b in found[1:]]
    curved = valued.mapInArrow(_curve(bounds, bits), "id long, size long, text_crc32 long, curve long")
    placed = positions(curved, ["curve", "id", "size", "text_crc32"], "hilbert-order")
    run = F.expr(f"position * {shards}L div {max(n, 1)}L")
    first = F.expr(f"(shard * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", run.cast("int")).withColumn("slot", F.col("position") - first).drop("position")


def write(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """``docs`` (unique ids) as Parquet files below ``path``, a folder per shard, rows in curve order."""
    where = placed.select(F.col("id").alias("_id"), "shard", "slot")
    rows = docs.join(where, F.col(f"`{id_col}`") == F.col("_id")).drop("_id")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)


def manifest(docs: DataFrame, placed: DataFrame, names: tuple[str, ...], id_col: str = "doc_id") -> DataFrame:
    """Rows, and minimum and maximum of each dimension, per shard: what a reader prunes by."""
    rows = docs.join(placed.select(F.col("id").alias("_id"), "shard"), F.col(f"`{id_col}`") == F.col("_id"))
    return rows.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), *[f(F.col(f"`{n}`")).alias(f"{w}_{n}") for n in names for w, f in (("min", F.min), ("max", F.max))])
