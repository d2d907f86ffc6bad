"""Nearest neighbours by inner product: multi-index hashing over learned rotated binary codes.

Vectors get one more component that makes their lengths equal, so the largest inner product is the smallest angle, and a
code of the signs after a learned rotation (principal directions, then iterative quantisation). A code's bytes are
indexed one by one. If two codes differ in at most r bits, some byte differs in at most r // bytes of them, so probing
the buckets around each byte of a query's code retrieves every code within r; these are reranked by the exact product.
The radius is learned too: it covers a set share of the true neighbours of some sampled queries.

Vectors lie in blocks, queries in chunks, and each pair of them is searched by itself, so nothing grows with the table
but the number of pairs. Equal vectors are one vector with several members.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import hold
from .tokens import gather

#: Vectors that the rotation is learned from, queries that the radius is learned from, and the share of true neighbours
#: that it is to cover.
SAMPLE, PROBES, COVER = 10_000, 200, 0.98
#: Numbers in a block of vectors and in a chunk of queries.
BLOCK_VALUES, CHUNK_VALUES = 1 << 20, 1 << 17
_MASKS = np.arange(256, dtype=np.uint8)
_MASKS = _MASKS[np.argsort(np.bitwise_count(_MASKS), kind="stable")]
_WITHIN = np.searchsorted(np.bitwise_count(_MASKS), np.arange(9), side="right")


def usable(vector: Column) -> Column:
    """No null or non-finite component, and not all zero."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(x: np.ndarray, steps: int = 30, seed: int = 7) -> np.ndarray:
    """Directions (a column each) whose signs are the code: the strongest principal ones, at most 64 and a multiple of
    eight (small dimensions repeat with other rotations), turned so that the signs lose least."""
    d = x.shape[1]
    bits = min(64, max(8, d // 8 * 8))
    _, axes = np.linalg.eigh(np.einsum("ni,nj->ij", x, x) / max(len(x), 1))
    axes = axes[:, ::-1][:, :bits]
    rng = np.random.default_rng(seed)
    parts, have = [], 0
    while have < bits:
        k = axes.shape[1]
        turn = np.linalg.qr(rng.standard_normal((k, k)))[0]
        v = np.einsum("ni,ij->nj", x, axes)
        for _ in range(steps):
            b = np.where(np.einsum("ni,ij->nj", v, turn) >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(np.einsum("ni,nj->ij", b, v))
            turn = np.einsum("ij,jk->ki", left, right)
        parts.append(np.einsum("ij,jk->ik", axes, turn))
        have += k
    return np.concatenate(parts, axis=1)[:, :bits]


def codes(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """The bytes of each vector's code, a row each."""
    return np.packbits(np.einsum("ni,ij->nj", x, turn) >= 0, axis=1)


def lengthened(x: np.ndarray, longest: float) -> np.ndarray:
    """One more component, so that all have the length ``longest``."""
    return np.column_stack([x, np.sqrt(np.maximum(longest ** 2 - (x * x).sum(axis=1), 0))])


class Index:
    """The bytes of a block's codes, each with its buckets."""

    def __init__(self, code: np.ndarray):
        self.code = code
        self.order = [np.argsort(c, kind="stable") for c in code.T]
        self.start = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(code.T, self.order)]

    def within(self, query: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code differs from the query's in at most ``radius`` bits."""
        m = len(query)
        each, more = divmod(min(radius, 8 * m), m)
        found = np.zeros(len(self.code), bool)
        for j in range(m):
            reach = each if j <= more else each - 1  # if all bytes differed in more, the sum would exceed the radius
            if reach < 0:
                continue
            bucket = (query[j] ^ _MASKS[: _WITHIN[min(reach, 8)]]).astype(np.int64)
            begin = self.start[j][bucket]
            found[gather(self.order[j], begin, self.start[j][bucket + 1] - begin)] = True
        rows = np.flatnonzero(found)
        return rows[np.bitwise_count(self.code[rows] ^ query).sum(axis=1) <= radius]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The k largest scores, ties to smaller ids."""
    if len(score) > k:
        edge = np.partition(score, len(score) - k)[len(score) - k]
        near = np.flatnonzero(score >= edge)
    else:
        near = np.arange(len(score))
    return near[np.lexsort((ids[near], -score[near]))[:k]]


def _pack(batches_table: pa.Table) -> pa.Table:
    ids = batches_table.column("rep").to_numpy()
    flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in batches_table.column("vector").chunks]).astype(np.float64)
    return pa.table({"part": pa.array([batches_table.column("part")[0].as_py()], pa.int32()), "ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                     "vectors": pa.array([flat.tobytes()], pa.binary())})


def _packed(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """``rep, vector`` as rows of about ``rows`` vectors each; ``name`` numbers them."""
    parts = -(-max(vectors.count(), 1) // rows)
    dealt = vectors.select((F.pmod(F.xxhash64("rep"), F.lit(parts))).cast("int").alias("part"), "rep", "vector")
    return dealt.groupBy("part").applyInArrow(_pack, "part int, ids binary, vectors binary").withColumnRenamed("part", name)


def _read(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, np.int64)
    return i, np.frombuffer(vectors, np.float64).reshape(len(i), -1)


def _search(turn: np.ndarray | None, longest: float, radius: int, k: int):
    """The k best of a block for each query of a chunk; with ``turn`` None by comparing all."""
    def run(batches):
        for b in batches:
            for ids, vectors, qids, queries in zip(*(b.column(c).to_pylist() for c in ("ids", "vectors", "qids", "queries"))):
                i, x = _read(ids, vectors)
                qi, q = _read(qids, queries)
                if turn is not None:
                    index = Index(codes(lengthened(x, longest), turn))
                    asked = codes(np.column_stack([q, np.zeros(len(q))]), turn)
                out = []
                for r in range(len(q)):
                    rows = np.arange(len(i)) if turn is None else index.within(asked[r], radius)
                    if len(rows) < k:
                        rows = np.arange(len(i))
                    score = (x[rows] * q[r]).sum(axis=1)
                    best = _best(score, i[rows], k)
                    out.append((np.full(len(best), qi[r]), i[rows][best], score[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], names=["query", "rep", "score"])
    return run


def _pairs(blocks: DataFrame, chunks: DataFrame, n: int) -> DataFrame:
    """Each block beside each of the ``n`` chunks of the stated queries."""
    each = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return each.join(chunks.select("chunk", F.col("ids").alias("qids"), F.col("vectors").alias("queries")), "chunk")


def learn(vectors: DataFrame, blocks: DataFrame, queries: DataFrame, k: int) -> tuple[np.ndarray, float, int]:
    """Rotation, length and radius, from ``SAMPLE`` vectors and the true neighbours of ``PROBES`` queries."""
    longest = vectors.agg(F.max(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)))).first()[0] or 1.0
    sample = np.array([r[0] for r in vectors.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("vector").collect()])
    turn = rotation(lengthened(sample, longest))
    some = hold(queries.orderBy(F.xxhash64("rep"), "rep").limit(PROBES), "ann-probes")
    truth = _pairs(blocks, _packed(some, PROBES, "chunk").withColumn("chunk", F.lit(0)), 1).mapInArrow(_search(None, 0, 0, k), "query long, rep long, score double")
    top = truth.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "rep"))).where(F.col("rank") <= k)
    near = top.where("query <> rep").join(vectors.select("rep", F.col("vector").alias("x")), "rep").join(
        some.select(F.col("rep").alias("query"), F.col("vector").alias("q")), "query").select("q", "x").collect()  # k for each probe
    if not near:
        return turn, longest, 8 * turn.shape[1]
    q, x = (np.array([r[c] for r in near]) for c in ("q", "x"))
    apart = np.bitwise_count(codes(np.column_stack([q, np.zeros(len(q))]), turn) ^ codes(lengthened(x, longest), turn)).sum(axis=1)
    return turn, longest, int(np.ceil(np.quantile(apart, COVER)))


def search(
    table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", method: str = "index",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row where ``is_query`` holds its ``k`` nearest other rows found, by the
    inner product in double precision; ties to the smaller id. ``method="all"`` compares everything, in the same blocks.

    Null, empty or zero vectors, vectors with null or non-finite components, rows without an id, and vectors of another
    length than most take no part. A row that repeats counts once. Fewer than ``k`` others give all of them.
    """
    ident, vector = F.col(f"`{id_col}`").cast("long"), F.col(f"`{vector_col}`").cast("array<double>")
    rows = table.select(ident.alias("id"), vector.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable(F.col("vector")) & F.col("id").isNotNull())
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "d").first()
    d = sizes["d"] if sizes else 1
    rows = hold(rows.where(F.size("vector") == d).distinct(), "ann-rows")
    same = Window.partitionBy("vector").orderBy("id")
    members = hold(rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= k + 1).select("id", "vector", "place"), "ann-members")
    vectors = members.where("place = 1").select(F.col("id").alias("rep"), "vector")
    asking = hold(rows.where("asks").select(F.col("id").alias("query_id"), "vector").join(vectors, "vector"), "ann-queries")
    queries = asking.select("rep", "vector").distinct()
    blocks = hold(_packed(vectors, max(1, BLOCK_VALUES // d), "block"), "ann-blocks")
    per_chunk = max(1, CHUNK_VALUES // d)
    n = -(-max(queries.count(), 1) // per_chunk)
    if method == "all" or not sizes:
        how = None, 1.0, 0
    else:
        how = learn(vectors, blocks, queries, k + 1)
    chunks = hold(_packed(queries, per_chunk, "chunk"), "ann-chunks")
    pairs = _pairs(blocks, chunks, n)
    found = pairs.repartition("block", "chunk").mapInArrow(_search(*how, k + 1), "query long, rep long, score double")
    nearest = Window.partitionBy("query").orderBy(F.col("score").desc(), "rep")
    top = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k + 1).drop("rank")
    group = members.join(vectors.withColumnRenamed("rep", "first"), "vector").select(F.col("first").alias("rep"), F.col("id").alias("vec_id"))
    each = top.join(group, "rep").join(asking.select("query_id", F.col("rep").alias("query")), "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
