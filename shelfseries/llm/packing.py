"""Packing token sequences: cutting-stock patterns over a histogram of lengths, assigned to ranked documents.

A document is cut into full sequences and one remainder. The histogram of remainders, in classes of a few tokens, is the
whole input of the linear program (`cutting`), which runs on the driver with a size that the sequence length bounds.
Remainders are ranked within their class over all partitions, and a rank says by arithmetic which use of which pattern
it fills. A pattern is used only where it wastes little; remainders without one, and those beyond the rounded patterns, are
strung together and cut at sequence ends. The last sequence is cut into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bpe, cutting, tokens
from .staging import hold, positions

_PIECE = "id long, key long, start long, length long, ids_crc32 long, doc_tokens long"


def _rows(rows, names, kinds):
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def _ended(numbers, ids, end_id: int):
    """``(id, key, ids)`` with the end behind the ids; the key tells apart texts that share an id."""
    end = np.array([end_id], "<u4")
    for i, x in zip(numbers, ids):
        yield i, xxhash.xxh3_64_intdigest(x) >> 1, np.concatenate([np.frombuffer(x, "<u4"), end])


def _measure(end_id: int, length: int):
    """Full pieces and the remainder of every document."""
    def run(batches):
        rows = []
        parts = (zip(b.column("row").to_pylist(), b.column("ids")) for b in bpe.assembled(batches))
        for i, key, ids in (x for part in parts for x in _ended(*zip(*((i, ids.as_py()) for i, ids in part)), end_id)):
            for at in range(0, len(ids), length):
                part = ids[at:at + length]
                rows.append((i, key, at, len(part), zlib.crc32(part.tobytes()), len(ids)))
            if len(rows) > 20_000:
                yield _rows(rows, ("id", "key", "start", "length", "ids_crc32", "doc_tokens"), [pa.int64()] * 6)
                rows = []
        if rows:
            yield _rows(rows, ("id", "key", "start", "length", "ids_crc32", "doc_tokens"), [pa.int64()] * 6)
    return run


def _place(plan: list, classes: list[int], first: dict[int, int], full: int):
    """Sequence and place in it of a piece, from its class and its rank there; -1 where no pattern has room."""
    base, bases = 0, []
    for _, uses in plan:
        bases.append(base)
        base += uses
    slots = {}
    for k, c in enumerate(classes):
        mine = [(p, int(counts[k]), uses) for p, (counts, uses) in enumerate(plan) if counts[k]]
        each = np.array([a for _, a, _ in mine], np.int64)
        slots[c] = (np.cumsum([0] + [a * u for _, a, u in mine]), np.array([bases[p] for p, _, _ in mine], np.int64), each)

    def run(batches):
        for b in batches:
            cls = b.column("cls").to_numpy(zero_copy_only=False)
            rank = b.column("position").to_numpy(zero_copy_only=False)
            seq, slot = np.full(len(cls), -1, np.int64), np.zeros(len(cls), np.int64)
            for c in np.unique(cls):
                at = np.flatnonzero(cls == c)
                r = rank[at] - first[int(c)]
                if c == 0:
                    seq[at] = base + r
                    continue
                ends, starts, each = slots[int(c)]
                ok = r < ends[-1]
                at, r = at[ok], r[ok]
                p = np.searchsorted(ends, r, side="right") - 1
                r = r - ends[p]
                seq[at] = starts[p] + r // each[p]
                slot[at] = int(c) * (1 << 20) + r % each[p]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(seq), pa.array(slot)], names=[*b.schema.names, "sequence_id", "slot"])
    return run, base + full


def tail_cuts(total: int, length: int) -> list[int]:
    """Where a run of ``total`` tokens is cut after its last full sequence: the rest in falling powers of two."""
    at, cuts = total - total % length, []
    for bit in range(length.bit_length(), -1, -1):
        if (total % length) >> bit & 1:
            cuts.append(at)
            at += 1 << bit
    return cuts


def _string(total: int, length: int, first_sequence: int):
    """Pieces of the left-over run, cut where sequences end; ``ids_crc32`` of a cut piece is null."""
    body = total // length
    cuts = np.array(tail_cuts(total, length), np.int64)

    def run(batches):
        for b in batches:
            rows = []
            columns = [b.column(c).to_pylist() for c in ("id", "key", "start", "length", "ids_crc32", "doc_tokens", "position")]
            for i, key, start, n, crc, of, at in zip(*columns):
                end, here = at + n, at
                while here < end:
                    if here < body * length:
                        seq, begin = here // length, here // length * length
                        stop = begin + length
                    else:
                        k = int(np.searchsorted(cuts, here, side="right")) - 1
                        seq, begin = body + k, int(cuts[k])
                        stop = int(cuts[k + 1]) if k + 1 < len(cuts) else total
                    to = min(end, stop)
                    whole = here == at and to == end
                    rows.append((i, key, start + here - at, to - here, crc if whole else None, of, first_sequence + seq, here - begin))
                    here = to
            if rows:
                yield _rows(rows, ("id", "key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"), [pa.int64()] * 8)
    return run


def _remainders(path: str, end_id: int, length: int):
    """The ids behind the last full sequence of documents, which are encoded again."""
    def run(batches):
        coder = tokens.WordEncoder(path)
        for b in batches:
            encoded = (x.astype("<u4").tobytes() for x in coder.texts(x.as_py() for x in b.column("body")))
            rows = [(i, key, len(ids) - len(ids) % length, ids[len(ids) - len(ids) % length:].tobytes())
                    for i, key, ids in _ended(b.column("id").to_pylist(), encoded, end_id)]
            yield _rows(rows, ("id", "key", "since", "ids"), [pa.int64()] * 3 + [pa.binary()])
    return run


def pack(
    docs: DataFrame, length: int = 2048, step: int = 8, end_id: int = 1, path: str | None = None,
    id_col: str = "doc_id", text_col: str = "text", waste: float = 1 / 56,
) -> DataFrame:
    """Pieces of all documents in sequences of at most ``length`` tokens: ``id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset``.

    A document's tokens are the ids of its words and ``end_id``; null and blank texts have that id alone. ``length`` is a
    power of two and a multiple of ``step``, the width of a length class. A pattern's sequences waste no more than ``waste`` of
    their tokens, by the mean lengths of its classes; all other sequences are full. Every token lies in one piece; offsets in a sequence are gapless. Rows that repeat are packed each on its
    own; a null id stays null. Other columns are not read; an empty table gives no rows.
    """
    if length & (length - 1) or length % step:
        raise ValueError("length must be a power of two and a multiple of step")
    path = path or tokens.public()
    placed = bpe.placed(docs, path, id_col, text_col, None, False)
    cls = F.when(F.col("length") == length, 0).otherwise(F.ceil(F.col("length") / step)).cast("int")
    measured = placed.mapInArrow(_measure(end_id, length), _PIECE).withColumns({
        "id": F.when(F.col("id") != bpe.NO_ID, F.col("id")), "cls": cls})
    # ranging a table samples it first, which would run the encoder twice
    measured = hold(measured.withColumn("mixed", F.xxhash64("id", "key", "start")), "pack-measured")
    # a class is ranked in mixed order, so that every part of it has the mean length of the class
    ranked = positions(measured, ["cls", "mixed", "id", "key", "start"], "pack-pieces").drop("mixed")

    found = ranked.groupBy("cls").agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean")).collect()  # a row per class
    counts, mean = {r["cls"]: r["n"] for r in found}, {r["cls"]: r["mean"] for r in found}
    first, seen = {}, 0
    for c in sorted(counts):
        first[c], seen = seen, seen + counts[c]
    classes = [c for c in sorted(counts) if c]
    demand = np.array([counts[c] for c in classes], np.int64)
    fill = np.array([mean[c] / step for c in classes])
    plan, _ = cutting.rounded(*cutting.solve(np.array(classes, np.int64), demand, length // step, fill=fill, waste=waste), demand)
    place, used = _place(plan, classes, first, counts.get(0, 0))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema)
    placed = ranked.mapInArrow(place, f"{schema}, sequence_id long, slot long")

    inside = Window.partitionBy("sequence_id").orderBy(F.col("slot").desc())  # at most ``length`` pieces
    offset = F.sum("length").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    out = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    packed = placed.where("sequence_id >= 0").withColumn("offset", F.coalesce(offset, F.lit(0)).cast("long")).select(*out)

    spare = positions(placed.where("sequence_id < 0").select("id", "key", "start", "length", "ids_crc32", "doc_tokens"),
                      ["id", "key", "start"], "pack-spare", F.col("length"))
    total = spare.agg(F.sum("length")).first()[0] or 0
    strung = hold(spare.mapInArrow(_string(total, length, used), "id long, key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"), "pack-strung")
    # pieces cut at a sequence end: two for each sequence of the strung run, so they stay on the cluster
    cut = strung.where("ids_crc32 is null").select("id", "key").distinct()
    ident = F.col(f"`{id_col}`").cast("long")
    body = F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("body")
    again = docs.select(ident.alias("id"), body).alias("d").join(
        cut.select("id").distinct().alias("c"), F.col("d.id").eqNullSafe(F.col("c.id")), "left_semi")
    ends = hold(again.mapInArrow(_remainders(path, end_id, length), "id long, key long, since long, ids binary").dropDuplicates(["id", "key"]), "pack-ends")
    joined = strung.where("ids_crc32 is null").alias("l").join(
        ends.alias("r"), F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.key") == F.col("r.key")), "left")
    own = F.substring(F.col("ids"), ((F.col("l.start") - F.col("since")) * 4 + 1).cast("int"), (F.col("l.length") * 4).cast("int"))
    summed = joined.select("l.id", "l.start", "l.length", F.crc32(own).alias("ids_crc32"), "l.doc_tokens", "l.sequence_id", "l.offset")
    return packed.unionByName(strung.where("ids_crc32 is not null").select(*out)).unionByName(summed)
