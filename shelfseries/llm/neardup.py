"""Near-duplicates: MinHash signatures, an inverted join over signature coordinates, exact confirmation, components.

Every distinct shingle set posts its id under each (coordinate, value) of its signature. A pair whose signatures agree in
at least ``matches`` of ``coords`` coordinates has a key in common among the ``coords - matches + 1`` rarest keys of either
(prefix), so only those lists are merged. The long lists behind them are skipped: members carry their signatures, so the
collisions of two members are counted where they meet first. Pairs with ``matches`` collisions are retained, narrowed by a
second sketch of 1024 one-byte minima, and confirmed on the full shingle sets.

Lists of a thousand near copies would give a million pairs. So the members of a list are first tied to its most central
one, which joins most of the list into one component; a list whose members are all in one component holds no unknown
link. In lists with several components every member outside the largest is tied to the most similar others, and at last
all pairs across components that pass are confirmed, so no link between components is lost. Long lists are compared in
blocks, inside tasks: only members outside a list's largest component are put to all of its blocks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import components
from .staging import hold
from .words import mix, window_hashes, word_hashes

#: Minima of the sketch; members of a list that are compared at once; similar others a member is tied to in a round.
BINS, BLOCK, BEST = 1024, 2048, 2
_ROUNDS = 2
_EARLY_STEPS = 2


def shingles(raw: bytes, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words, A-Z in lower case; the whole sequence if it is shorter."""
    h = word_hashes(raw.lower())
    if not len(h):
        return h
    return np.unique(window_hashes(h, min(k, len(h))) ^ np.uint64(min(k, len(h))))


def _signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    least = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(grams), 4096):
        rows = (grams[at:at + 4096, None] * a + b) >> np.uint64(32)
        np.minimum(least, rows.min(axis=0), out=least)
    return least.astype(np.uint32)


def sketch(grams: np.ndarray) -> np.ndarray:
    """A byte of the smallest hash in each of ``BINS`` equal ranges of hashes; 0 where a range has none."""
    edges = np.arange(BINS + 1, dtype=np.float64) * (2.0 ** 64 / BINS)
    starts = np.searchsorted(grams, edges[:-1].astype(np.uint64))
    ends = np.append(starts[1:], len(grams))
    out = np.zeros(BINS, np.uint8)
    have = starts < ends
    out[have] = 1 + grams[starts[have]] % np.uint64(255)
    return out


def alike(one: np.ndarray, others: np.ndarray, size: int, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Share of ranges in which sketches agree, and whether it is within 4.5 standard deviations of the bound.

    A filled range draws one element of the union, none twice, so the spread is hypergeometric: small for sets of which
    the ranges hold nearly all elements.
    """
    n = np.maximum(((one != 0) | (others != 0)).sum(axis=1), 1)
    same = ((one == others) & (one != 0)).sum(axis=1)
    j = percent / 100
    union = np.maximum((size + sizes) / (1 + j), n)
    spread = np.sqrt(j * (1 - j) * n * (union - n) / np.maximum(union - 1, 1))
    return same / n, same >= j * n - 4.5 * spread - 1


def collisions(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Coordinates that a signature shares with each of the others: the lists, merged or skipped, that hold both."""
    return (one == others).sum(axis=1)


def _sign(k: int, coords: int):
    def run(batches):
        seeds = mix(np.arange(1, 2 * coords + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        a, b = seeds[:coords] | np.uint64(1), seeds[coords:]
        for batch in batches:
            sizes, prints, sigs, sketches = [], [], [], []
            for body in batch.column("body"):
                grams = shingles(body.as_py(), k)
                sizes.append(len(grams))
                prints.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None)
                sigs.append(_signature(grams, a, b).tobytes() if len(grams) else None)
                sketches.append(sketch(grams).tobytes() if len(grams) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sigs, pa.binary()), pa.array(sketches, pa.binary())],
                names=["id", "n_shingles", "fp", "sig", "sketch"])
    return run


def _post(batches):
    """(coordinate, value) keys of signatures, as one long each."""
    for batch in batches:
        sigs = batch.column("sig").to_pylist()
        for at in range(0, len(sigs), 2000):
            block = np.stack([np.frombuffer(s, np.uint32) for s in sigs[at:at + 2000]]).astype(np.int64)
            block += np.arange(block.shape[1], dtype=np.int64) << 32
            ids = batch.column("rep").slice(at, len(block)).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, block.shape[1])), pa.array(block.ravel())], names=["rep", "key"])


def _agree(percent: int, matches: int):
    """Pairs with enough collisions whose sketches are alike enough."""
    def run(batches):
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("sig_a", "sig_b", "sketch_a", "sketch_b", "n_a", "n_b")]
            good = [bool(collisions(np.frombuffer(s, np.uint32), np.frombuffer(t, np.uint32)[None])[0] >= matches
                         and alike(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)[None], n, np.array([m]), percent)[1][0])
                    for s, t, x, y, n, m in zip(*columns)]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _compare(percent: int, matches: int, every: bool):
    """Pairs of a member that asks and one at home in the block, of different components, whose collisions, sketches and
    sizes allow a link: all of them, each in the first list that both members stand in, or the ``BEST`` of each that
    asks."""
    def pairs(rows):
        key = rows[0][0]
        rep, comp, size = (np.array([r[c] for r in rows], np.int64) for c in (3, 4, 5))
        minor, home, asks = (np.array([r[c] for r in rows], bool) for c in (6, 7, 8))
        sigs = np.frombuffer(b"".join([r[9] for r in rows]), np.uint32).reshape(len(rows), -1)
        marks = np.frombuffer(b"".join([r[10] for r in rows]), np.uint8).reshape(len(rows), BINS)
        keys = [np.array(r[11], np.int64) for r in rows] if every else None
        for x in np.flatnonzero(asks):
            there = home & (comp != comp[x]) & (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x]))
            if every:  # two that ask meet twice
                there &= ~minor | (rep > rep[x])
            other = np.flatnonzero(there)
            other = other[collisions(sigs[x], sigs[other]) >= matches]
            if not len(other):
                continue
            share, near = alike(marks[x], marks[other], size[x], size[other], percent)
            other, share = other[near], share[near]
            if every:
                other = [y for y in other if np.intersect1d(keys[x], keys[y], assume_unique=True)[0] == key]
            else:
                other = other[np.argsort(-share, kind="stable")[:BEST]]
            for y in other:
                yield int(min(rep[x], rep[y])), int(max(rep[x], rep[y]))

    def run(batches):
        group, found = [], []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in batch.schema.names)):
                if group and row[:3] != group[0][:3]:
                    found.extend(pairs(group))
                    group = []
                group.append(row)
                if len(found) > 50_000:
                    yield _pairs(found)
                    found = []
        if group:
            found.extend(pairs(group))
        yield _pairs(found)
    return run


def _pairs(found):
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _confirm(k: int, percent: int):
    """Pairs whose full shingle sets are similar enough."""
    def run(batches):
        known, grams = None, None
        for batch in batches:
            good = []
            for a, x, y in zip(batch.column("a").to_pylist(), batch.column("body_a"), batch.column("body_b")):
                if a != known:
                    known, grams = a, shingles(x.as_py(), k)
                other = shingles(y.as_py(), k)
                common = len(np.intersect1d(grams, other, assume_unique=True))
                good.append(100 * common >= percent * (len(grams) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _prefix(reps: DataFrame, coords: int, matches: int) -> DataFrame:
    """``rep, key, central`` of the rarest keys that are shared at all; keys of one set alone count as rarest and stay
    out. ``central`` says how much the set's keys are shared."""
    postings = reps.mapInArrow(_post, "rep long, key long")
    shared = hold(postings.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where("f > 1"), "neardup-shared")
    mine = Window.partitionBy("rep")  # at most ``coords`` rows
    ranked = postings.join(shared, "key").withColumns({
        "n": F.count(F.lit(1)).over(mine), "central": F.sum("f").over(mine), "rank": F.row_number().over(mine.orderBy("f", "key"))})
    return ranked.where((F.col("n") >= matches) & (F.col("rank") + coords - F.col("n") <= coords - matches + 1)).select("rep", "key", "central")


def _still_open(lists: DataFrame, comps: DataFrame) -> DataFrame:
    """Lists with the component of each member, without lists of a single component, and with the list's largest component
    (``major``), its number of ``blocks`` of members and of ``chunks`` of members outside that component."""
    found = lists.select("rep", "key").join(comps, lists["rep"] == comps["u"], "left").select("rep", "key", F.coalesce("component", "rep").alias("comp"))
    sizes = found.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = sizes.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("most"), F.sum("n").alias("n")).where(F.col("n") > F.col("most.n")).select(
        "key", F.col("most.comp").alias("major"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("n") - F.col("most.n")) / BLOCK).cast("int").alias("chunks"))
    return hold(found.join(mixed, "key"), "neardup-lists")


def _stars(lists: DataFrame) -> DataFrame:
    """Each member of a list with the list's most central one."""
    centre = lists.groupBy("key").agg(F.max(F.struct("central", (-F.col("rep")).alias("minus"))).alias("c")).select(
        "key", (-F.col("c.minus")).alias("centre"))
    return lists.join(hold(centre, "neardup-centres"), "key").where("rep <> centre").select(
        F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()


def _dealt(lists: DataFrame) -> DataFrame:
    """From :func:`_still_open`: ``key, block, chunk, rep, comp, minor, home, asks``: members of a list dealt to blocks, and those outside its largest
    component (minor) to chunks. A member is at home in its block, beside each chunk; a minor one asks in each block with
    its chunk. So a list of ``m`` members with few minor ones gives little more than ``m`` rows, and no group more than
    about two blocks."""
    members = lists.withColumns({
        "minor": F.col("comp") != F.col("major"),
        "mine": F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"),
        "own": F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")})

    def place(block, chunk):
        return F.struct(block.cast("int").alias("block"), chunk.cast("int").alias("chunk"))

    at_home = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: place(F.col("mine"), c))
    asking = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda b: place(b, F.col("own")))
    places = F.when(F.col("minor"), F.array_union(at_home, asking)).otherwise(at_home)
    return members.withColumn("at", F.explode(places)).select(
        "key", "at.block", "at.chunk", "rep", "comp", "minor", (F.col("mine") == F.col("at.block")).alias("home"),
        (F.col("minor") & (F.col("own") == F.col("at.chunk"))).alias("asks"))


def _across(lists: DataFrame, sets: DataFrame, percent: int, matches: int, every: bool) -> DataFrame:
    """Pairs across components within lists (see :func:`_compare`), block by block."""
    members = _dealt(lists).join(sets, "rep")
    columns = ["key", "block", "chunk", "rep", "comp", "n_shingles", "minor", "home", "asks", "sig", "sketch"]
    if every:
        keys = lists.groupBy("rep").agg(F.sort_array(F.collect_list("key")).alias("keys"))  # as many as the prefix has
        members = members.join(hold(keys, "neardup-keys"), "rep")
        columns.append("keys")
    dealt = members.select(*columns).repartition("key", "block", "chunk").sortWithinPartitions("key", "block", "chunk")
    return dealt.mapInArrow(_compare(percent, matches, every), "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, coords: int = 64, matches: int = 32,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: ``id, n_shingles, component`` (the smallest id reachable over links, itself included).

    Two rows are linked when ``100 * |A and B| >= percent * |A or B|`` for their shingle sets; equal sets are grouped
    before anything is compared. A set of fewer words than ``shingle`` is its whole sequence; null and blank texts have
    an empty set and no links. A row without an id has a null component; rows that share an id count as one. A pair at
    the similarity bound is missed with a chance of about 1e-8 by the count of collisions, at the default 32 of 64
    coordinates, and of about 3e-6 by the sketch. Other columns are not read; an empty table gives
    no rows.
    """
    body = F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), body.alias("body"))
    signed = hold(rows.mapInArrow(_sign(shingle, coords), "id long, n_shingles long, fp binary, sig binary, sketch binary"), "neardup-signatures")
    sets = signed.where("fp is not null and id is not null")
    first = [F.first(c).alias(c) for c in ("n_shingles", "sig", "sketch")]
    reps = sets.groupBy("fp").agg(F.min("id").alias("rep"), *first).groupBy("rep").agg(*first)
    reps = hold(reps, "neardup-sets")
    lists = hold(_prefix(reps.select("rep", "sig"), coords, matches), "neardup-lists")
    listed = lists.select("rep").distinct()
    named = hold(reps.select("rep", "n_shingles", "sig", "sketch").join(listed, "rep", "left_semi"), "neardup-sketches")
    bodies = hold(rows.where("id is not null").join(listed, F.col("id") == F.col("rep"), "left_semi").dropDuplicates(["id"]), "neardup-texts")

    def links(pairs: DataFrame) -> DataFrame:
        x, y = (bodies.select(F.col("id").alias(n), F.col("body").alias(f"body_{n}")) for n in "ab")
        return hold(pairs.join(y, "b").join(x, "a").select("a", "b", "body_a", "body_b").mapInArrow(_confirm(shingle, percent), "a long, b long").select(
            F.col("a").alias("u"), F.col("b").alias("v")), "neardup-links")

    a, b = (named.select(F.col("rep").alias(n), F.col("sig").alias(f"sig_{n}"), F.col("sketch").alias(f"sketch_{n}"), F.col("n_shingles").alias(f"n_{n}")) for n in "ab")
    stars = _stars(lists).join(a, "a").join(b, "b").mapInArrow(_agree(percent, matches), "a long, b long")
    edges = links(hold(stars, "neardup-pairs"))
    for last in [False] * _ROUNDS + [True]:
        lists = _still_open(lists, components(edges, _EARLY_STEPS))
        edges = edges.unionByName(links(hold(_across(lists, named, percent, matches, last), "neardup-pairs")))
    comps = components(edges)

    groups = sets.groupBy("fp").agg(F.min("id").alias("rep"))
    tied = sets.select("id", "n_shingles", "fp").join(groups, "fp").select("id", "n_shingles", "rep")
    placed = tied.join(comps, tied["rep"] == comps["u"], "left").select(
        "id", "n_shingles", F.coalesce("component", "rep").alias("component"))
    alone = signed.where("fp is null or id is null").select("id", "n_shingles", F.col("id").alias("component"))
    return placed.unionByName(alone)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose id is the smallest of their component; rows without an id stay."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **how)
    keep = found.where("id = component").select(F.col("id").alias("keep_id")).distinct()
    ident = F.col(f"`{id_col}`")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), ident.cast("long").alias("id"))
    return whole.join(keep, F.col("id") == F.col("keep_id"), "left_semi").select("doc.*").unionByName(docs.where(ident.isNull()))
