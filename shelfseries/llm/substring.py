"""Removal of repeated word windows: a count-min prefilter, then exact grouping of what it suspects.

A window (50 words) is stood for by its minimiser, the hash-smallest of the 25-word runs in it, so neighbouring windows
share one and equal windows have equal ones. Every document adds its distinct minimisers once to a count-min sketch; a
window that occurs in two documents has a minimiser counted at least twice, and count-min never underestimates, so no
repeated window escapes. One more pass over the texts asks the sketch: documents without a suspected window are done with
it, the others are written out with a fingerprint and grouped by exact window hashes.

The sketch grows with the text, so it suspects no more at any size. Up to a stated size its bits are broadcast; beyond, the
cells that two documents fill stay a table, and the documents' minimisers are joined with it.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import hold, text_batches
from .words import hashes_and_text, mix, runs, window_hashes, word_hashes

#: The sketch has this many rows, each with its own hash; cells of a slice travel together.
ROWS, SLICE = 2, 1 << 16
_SALTS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))
#: The least number of cells in a row, and the most of a sketch that is broadcast: two rows of 64 MB of bits.
LEAST_CELLS, BROADCAST_CELLS = 1 << 20, 1 << 29
_FLUSH = 2_000_000


def minimisers(h: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` words the smallest hash among its runs of half that length."""
    gram = max(1, width // 2)
    m = window_hashes(h, gram)
    span = width - gram + 1
    if len(m) < span:
        return np.empty(0, np.uint64)
    done = 1
    while done * 2 <= span:
        m = np.minimum(m[:-done], m[done:])
        done *= 2
    rest = span - done
    return np.minimum(m[:-rest], m[rest:]) if rest else m


def _turns(m: np.ndarray) -> np.ndarray:
    """Where an entry differs from the one before; neighbouring windows mostly share their minimiser."""
    return np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]])) if len(m) else np.empty(0, np.int64)


def _distinct(raw: bytes, width: int) -> np.ndarray:
    """The distinct minimisers of a text."""
    m = minimisers(word_hashes(raw), width)
    return np.unique(m[_turns(m)])


def _cells(m: np.ndarray, row: int, cells: int) -> np.ndarray:
    return mix(m ^ _SALTS[row]) & np.uint64(cells - 1)


def _sketch_rows(seen: list[np.ndarray], cells: int):
    m = np.concatenate(seen)
    parts, offsets, counts = [], [], []
    for row in range(ROWS):
        cell, n = np.unique(_cells(m, row, cells), return_counts=True)
        piece = (cell // SLICE).astype(np.int64)
        cuts = np.flatnonzero(np.diff(piece)) + 1
        inside, n = (cell % SLICE).astype(np.uint16), np.minimum(n, 2).astype(np.uint8)
        for at, to in zip([0, *cuts], [*cuts, len(cell)]):
            if to > at:
                parts.append(row * (cells // SLICE) + int(piece[at]))
                offsets.append(inside[at:to].tobytes())
                counts.append(n[at:to].tobytes())
    return pa.RecordBatch.from_arrays(
        [pa.array(parts, pa.int64()), pa.array(offsets, pa.binary()), pa.array(counts, pa.binary())], names=["part", "offsets", "counts"])


def repeated_slices(docs: DataFrame, width: int, cells: int) -> DataFrame:
    """``part, bits``: slices of the sketch, a bit set for each cell that at least two documents fill.

    ``docs`` has ``id`` and ``body``. Partitions send the cells they filled; slices are summed in a stream sorted by
    slice, so a task holds one slice at a time, whatever the number of partitions.
    """
    def fill(batches):
        seen, n = [], 0
        for b in batches:
            for i, body in zip(b.column("id"), b.column("body")):
                if not i.is_valid:
                    continue
                m = _distinct(body.as_py(), width)
                if len(m):
                    seen.append(m)
                    n += len(m)
                if n > _FLUSH:
                    yield _sketch_rows(seen, cells)
                    seen, n = [], 0
        if seen:
            yield _sketch_rows(seen, cells)

    def merge(batches):
        part, total = None, None

        def result():
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([np.packbits(total >= 2, bitorder="little").tobytes()], pa.binary())], names=["part", "bits"])

        for b in batches:
            for p, o, c in zip(b.column("part").to_pylist(), b.column("offsets").to_pylist(), b.column("counts").to_pylist()):
                if p != part:
                    if part is not None:
                        yield result()
                    part, total = p, np.zeros(SLICE, np.uint8)
                at = np.frombuffer(o, np.uint16)
                total[at] = np.minimum(total[at] + np.frombuffer(c, np.uint8), 2)
        if part is not None:
            yield result()

    sketch = docs.mapInArrow(fill, "part long, offsets binary, counts binary").repartition("part").sortWithinPartitions("part")
    return sketch.mapInArrow(merge, "part long, bits binary")


def repeated_cells(docs: DataFrame, width: int, cells: int) -> np.ndarray:
    """The slices of :func:`repeated_slices`, one after the other, for a sketch of at most ``BROADCAST_CELLS``."""
    bits = np.zeros(ROWS * cells // 8, np.uint8)
    step = SLICE // 8
    for r in repeated_slices(docs, width, cells).toLocalIterator():  # at most ROWS * cells / SLICE rows
        bits[r["part"] * step:(r["part"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return bits


def repeated_marks(docs: DataFrame, width: int, cells: int) -> DataFrame:
    """``id, marks``: the minimisers of each document whose cells are set in all rows of the sketch, by joins with the table
    of set cells. A cell that many documents fill meets one row of that table, so its side can be split."""
    def flat(batches):
        for b in batches:
            for part, bits in zip(b.column("part").to_pylist(), b.column("bits").to_pylist()):
                at = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little"))
                yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64) + part * SLICE)], names=["cell"])

    def ask(batches):
        names = ["id", "mark", *(f"cell{r}" for r in range(ROWS))]
        for b in batches:
            for i, body in zip(b.column("id"), b.column("body")):
                if i.is_valid:
                    m = _distinct(body.as_py(), width)
                    at = [(_cells(m, r, cells) + np.uint64(r * cells)).astype(np.int64) for r in range(ROWS)]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(m), i.as_py(), np.int64), m.view(np.int64), *at)], names=names)

    filled = hold(repeated_slices(docs, width, cells).mapInArrow(flat, "cell long"), "substring-cells")
    asked = docs.mapInArrow(ask, "id long, mark long, " + ", ".join(f"cell{r} long" for r in range(ROWS)))
    for r in range(ROWS):
        asked = asked.join(filled.withColumnRenamed("cell", f"cell{r}"), f"cell{r}", "left_semi")
    return hold(asked.groupBy("id").agg(F.collect_set("mark").alias("marks")), "substring-marks")  # no more than a text has


def suspected(h: np.ndarray, width: int, known) -> np.ndarray:
    """Whether each window of the document may also occur in another; ``known`` tells it of minimisers."""
    m = minimisers(h, width)
    if not len(m):
        return np.empty(0, bool)
    begin = _turns(m)
    return np.repeat(known(m[begin]), np.diff(begin, append=len(m)))


def _by_bits(bits: Broadcast, cells: int):
    """For the ``i``-th document of a batch, what its sketch bits say of minimisers."""
    def known(few):
        maybe = np.ones(len(few), bool)
        for row in range(ROWS):
            at = _cells(few, row, cells) + np.uint64(row * cells)
            maybe &= (bits.value[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return maybe

    return lambda batch, i: known


def _by_marks(batch, i: int):
    """The same from the marks that the ``i``-th document was joined with."""
    marks = batch.column("marks")[i]
    own = marks.values.to_numpy(zero_copy_only=False).view(np.uint64) if marks.is_valid else np.empty(0, np.uint64)
    return lambda few: np.isin(few, own)


def _split(knows, width: int, suspects_only: bool):
    """A row per document, texts as their words joined by one blank: as ``kept`` where no window is suspected, else as
    ``body`` with its SHA-256 as ``fp``."""
    def run(batches):
        for b in batches:
            chosen, words, kept, bodies, prints = [], [], [], [], []
            for i, (ident, body) in enumerate(zip(b.column("id"), b.column("body"))):
                h, text = hashes_and_text(body.as_py())
                suspect = ident.is_valid and bool(suspected(h, width, knows(b, i)).any())
                if suspects_only and not suspect:
                    continue
                chosen.append(i)
                words.append(len(h))
                kept.append(None if suspect else text)
                bodies.append(text if suspect else None)
                prints.append(sha256(text).digest() if suspect else None)
            if chosen:
                names = [c for c in b.schema.names if c != "body"]
                out = b.select(names).take(pa.array(chosen))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(words, pa.int64()), *[pa.array(x, pa.binary()) for x in (kept, bodies, prints)]],
                    names=[*names, "n_words", "kept", "body", "fp"])
    return run


def _occurrences(knows, width: int):
    def run(batches):
        for b in batches:
            parts = []
            for i, (ident, body) in enumerate(zip(b.column("id").to_pylist(), b.column("body"))):
                h = word_hashes(body.as_py())
                at = np.flatnonzero(suspected(h, width, knows(b, i)))
                parts.append((np.full(len(at), ident), at, window_hashes(h, width)[at], window_hashes(h, width, 1)[at]))
                if sum(len(p[1]) for p in parts) > 500_000:
                    yield _windows(parts)
                    parts = []
            if parts:
                yield _windows(parts)
    return run


def _windows(parts):
    ids, at, w1, w2 = (np.concatenate(x) for x in zip(*parts))
    return pa.RecordBatch.from_arrays(
        [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(ids.astype(np.int64)), pa.array(at.astype(np.int32))],
        names=["w1", "w2", "id", "at"])


def _cut(width: int):
    def run(batches):
        for b in batches:
            words, removed, kept = [], [], []
            for body, starts in zip(b.column("body"), b.column("starts")):
                ws = [w for part in runs(body.as_py()) for w in part]
                edge = np.zeros(len(ws) + 1, np.int64)
                if starts.is_valid:
                    at = np.asarray(starts.values.to_numpy(), np.int64)
                    at = at[at + width <= len(ws)]
                    edge[at] += 1
                    edge[at + width] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                words.append(len(ws))
                removed.append(int(gone.sum()))
                kept.append(b" ".join([w for w, g in zip(ws, gone.tolist()) if not g]))
            names = [c for c in b.schema.names if c not in ("body", "starts")]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in names], pa.array(words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                names=[*names, "n_words", "n_removed", "kept"])
    return run


def cells_for(docs: DataFrame) -> int:
    """Cells of a sketch row: a power of two near an eighth of the bytes of text (ten times the minimisers of usual
    prose), whatever the size; a fuller sketch suspects more and is slower, never wrong."""
    size = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    return max(LEAST_CELLS, 1 << max(0, (size // 8 - 1).bit_length()))


def cut_repeats(
    docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), cells: int | None = None,
    changed_only: bool = False, most_broadcast: int = BROADCAST_CELLS,
) -> DataFrame:
    """Per row of ``docs``: ``id, n_words, n_removed, kept`` (UTF-8 bytes of the kept words, joined by one space), and a
    struct ``carried`` of the columns named in ``carry``.

    A word goes when a window of ``width`` words covers it whose words also stand in a row with a smaller id; windows
    are judged on the input. Null text has no words. A row without an id loses nothing and counts for nothing; rows that
    share an id must share the text and take nothing from each other. Documents with the same word sequence as a smaller id are grouped by
    SHA-256 and lose all words at once; their windows are not listed. An empty table gives no rows. With ``changed_only``
    rows that lose no word are left out, and texts without a suspected window are not written at all. A sketch of more than
    ``most_broadcast`` cells in a row is joined instead of broadcast; the result is the same.
    """
    columns = [F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("body")]
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried"))
    rows = docs.select(*columns)
    slim = rows.select("id", "body")
    cells = cells or cells_for(slim)
    keep = [c for c in rows.columns if c != "body"]
    if cells <= most_broadcast:
        knows, marks = _by_bits(docs.sparkSession.sparkContext.broadcast(repeated_cells(slim, width, cells)), cells), []
    else:
        knows, marks = _by_marks, ["marks"]
        rows = rows.join(repeated_marks(slim, width, cells), "id", "left").select(*rows.columns, "marks")

    extra = f", carried {rows.schema['carried'].dataType.simpleString()}" if carry else ""
    known = ", marks array<long>" if marks else ""
    with text_batches(docs.sparkSession):
        texts = hold(rows.select(*keep, *marks, "body").mapInArrow(
            _split(knows, width, changed_only), f"id long{extra}{known}, n_words long, kept binary, body binary, fp binary"), "substring-texts")
    clean, dubious = texts.where("fp is null"), texts.where("fp is not null")
    suspects = hold(dubious.select("id", "fp"), "substring-suspects")

    first = suspects.groupBy("fp").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    copies = hold(suspects.join(first.where("first < last"), "fp").where("id > first").select("id").distinct(), "substring-copies")
    firsts = dubious.join(copies, "id", "left_anti")
    occurrences = firsts.select("id", "body", *marks).mapInArrow(_occurrences(knows, width), "w1 long, w2 long, id long, at int")
    shared = occurrences.groupBy("w1", "w2").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    shared = hold(shared, "substring-shared")  # a table beside the windows, so that a window that many documents have can be split
    starts = occurrences.join(shared, ["w1", "w2"]).where("id > first").select("id", "at").distinct().groupBy("id").agg(F.collect_list("at").alias("starts"))
    cut = firsts.join(hold(starts, "substring-starts"), "id", "left").select(*keep, "body", "starts").mapInArrow(
        _cut(width), f"id long{extra}, n_words long, n_removed long, kept binary")
    whole = dubious.join(copies, "id", "left_semi").select(*keep, "n_words", F.col("n_words").alias("n_removed"), F.lit(b"").alias("kept"))
    if changed_only:
        return cut.unionByName(whole).where("n_removed > 0")
    return clean.select(*keep, "n_words", F.lit(0).cast("long").alias("n_removed"), "kept").unionByName(cut).unionByName(whole)


def without_repeats(docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """The rows of ``docs``, all columns unchanged but ``text_col``, and ``chars_col`` if there is one: a text that loses words
    by :func:`cut_repeats` becomes its kept words, joined by one space, other texts stay as they are.

    Only changed texts come back from the operator; they join the documents by id and the text's hash, which may be stored
    by then. Rows without an id stay as they are; rows that repeat are cut alike; an empty table stays empty.
    """
    def mark(text):
        return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))

    text = F.col(f"`{text_col}`")
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), mark(text).alias("hash"))
    cut = cut_repeats(slim, width, "id", "text", ("hash",), changed_only=True)
    cut = hold(cut.select("id", F.col("carried.hash").alias("hash"), F.col("kept").cast("string").alias("kept")).dropDuplicates(["id", "hash"]), "substring-changed")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col(f"`{id_col}`").cast("long").alias("own"), mark(text).alias("mark"))
    joined = whole.join(cut, (F.col("own") == F.col("id")) & (F.col("mark") == F.col("hash")), "left").select("doc", "kept")
    new = {text_col: F.col("kept"), chars_col: F.length("kept")}
    return joined.select(*[
        F.when(F.col("kept").isNull(), F.col(f"doc.`{c}`")).otherwise(new[c].cast(docs.schema[c].dataType)).alias(c) if c in new else F.col(f"doc.`{c}`")
        for c in docs.columns])
