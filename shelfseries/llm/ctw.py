"""Context-tree weighting over bytes.

A text is its words with a blank between them and a line feed at the end. Each byte is eight binary decisions; the
decisions after the same bits have a tree of their own over the ``DEPTH`` bytes before. Every node has the
Krichevsky-Trofimov estimate of what it has seen, and a node's weighted probability is half its own estimate and half the
product of its children's. From these the share of each depth in the next decision follows, so all depths are mixed for
every bit. Counts come from all training documents, and nothing of them is dropped: codes (a byte with its context) and
words are tables, trees below ``ROOT`` bytes of context are worked out by tasks that have all of a tree's codes, and each
code of the corpus gets its value once. Documents find frequent codes and words in tables of fixed size, the others by a
join.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frequent import HEAD, MORE, Frequent, Places, frequent, hashes, least_count
from .staging import hold, text_batches, tidy
from .words import Slots, find, lower_words, runs

#: Bytes of context.
DEPTH = 6
#: Tasks have whole trees below contexts of so many bytes. The nodes above are collected; their number is bounded by the
#: bytes that there are, not by the input.
ROOT = 3
#: Codes that tasks look up in memory, the most frequent ones; all others are joined.
HEAD_CODES = 1 << 21
#: Codes whose trees a task works out together, about.
_SLICE = 500_000
#: Byte after a text, and before it, as often as there are bytes of context.
END = b"\n"
_FLUSH = 400_000
#: Bytes that are looked at together, and bytes that 32 bits count for sure.
_CHUNK, _COUNTED = 2 << 20, 1 << 30


def stream(body: bytes) -> bytes:
    """The bytes that are coded: A-Z in lower case, one blank between words, a line feed at the end."""
    return b" ".join([b" ".join(ws) for ws in runs(body.lower()) if ws]) + END


def codes_after(before: bytes, data: bytes) -> np.ndarray:
    """Each byte of ``data`` with the ``len(before)`` bytes in front of it: the byte itself lowest, then the one before."""
    depth = len(before)
    if not data:
        return np.empty(0, np.uint64)
    out = np.ndarray(len(data), ">u8", bytes(7 - depth) + before + data, strides=(1,)).astype(np.uint64)  # eight bytes ending in each
    out &= _mask(depth)
    return out


def coded(bodies, depth: int, chunk: int | None = None):
    """``(texts, codes, begin, size)`` for stretches of texts: the numbers of the texts that the stretch has parts of,
    codes of all their bytes, and where in the codes each part stands."""
    group, held, pad, chunk = [], 0, END * depth, chunk or _CHUNK

    def stretch():
        data = (END * (depth - 1)).join([x for _, x in group])
        size = np.array([len(x) for _, x in group], np.int64)
        begin = np.cumsum(size + depth - 1) - size - (depth - 1)
        return [k for k, _ in group], codes_after(pad, data), begin, size

    for k, body in enumerate(bodies):
        data = stream(body)
        if len(data) > chunk:
            for at in range(0, len(data), chunk):
                part = data[at:at + chunk]
                yield [k], codes_after((pad + data[max(0, at - depth):at])[-depth:], part), np.zeros(1, np.int64), np.array([len(part)])
            continue
        group.append((k, data))
        held += len(data)
        if held > chunk:
            yield stretch()
            group, held = [], 0
    if group:
        yield stretch()


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: Stirling's series after a shift by eight."""
    shift = np.log(x) + np.log(x + 1) + np.log(x + 2) + np.log(x + 3) + np.log(x + 4) + np.log(x + 5) + np.log(x + 6) + np.log(x + 7)
    z = x + 8
    r = 1 / (z * z)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / z
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log-probability of a sequence with so many zeros and ones under the Krichevsky-Trofimov estimator."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1.0) - np.log(np.pi)


def _sum_by(keys: np.ndarray, counts: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    if counts is None:
        few, n = np.unique(keys, return_counts=True)
        return few, n.astype(float)
    few, at = np.unique(keys, return_inverse=True)
    return few, np.bincount(at, counts, len(few))


def _mask(depth: int) -> np.uint64:
    return np.uint64((1 << 8 * (depth + 1)) - 1)


class Tree:
    """All trees of a depth-``depth`` model, from counts per (context, byte) code as :func:`codes_after` gives them.

    ``pruned`` may hold counts for greater depths that lack rare contexts; ``codes`` are those of the greatest depth
    that is complete, or of ``depth`` itself.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, depth: int = DEPTH, full: int | None = None, pruned: dict | None = None):
        self.depth = depth
        full = depth if full is None else full
        tables = {d: _sum_by(*pruned[d]) for d in range(full + 1, depth + 1)} if pruned else {}
        tables[full] = _sum_by(codes, counts)
        for d in range(full - 1, -1, -1):
            tables[d] = _sum_by(tables[d + 1][0] & _mask(d), tables[d + 1][1])
        self.keys, self.one, self.stop = {}, {}, {}
        below: dict[int, tuple] = {}
        for d in range(depth, -1, -1):
            table, n = tables[d]
            now = {}
            for level in range(8):
                prefix = table >> np.uint64(8 - level)
                begin = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]])) if len(prefix) else np.empty(0, np.int64)
                bit = (table >> np.uint64(7 - level)) & np.uint64(1)
                both = np.add.reduceat(n, begin) if len(begin) else np.empty(0)
                ones = np.add.reduceat(n * bit, begin) if len(begin) else np.empty(0)
                zeros, keys = both - ones, prefix[begin]
                own = log_kt(zeros, ones)
                if d == depth:
                    weighted, stop = own, np.ones(len(own))
                else:
                    deeper, lw, z, o = below[level]
                    at = np.searchsorted(keys, deeper & np.uint64((1 << (8 * d + level)) - 1))
                    rest0 = zeros - np.bincount(at, z, len(keys))
                    rest1 = ones - np.bincount(at, o, len(keys))
                    children = np.bincount(at, lw, len(keys)) + log_kt(np.maximum(rest0, 0), np.maximum(rest1, 0))
                    weighted = np.logaddexp(own, children) - np.log(2)
                    stop = np.exp(own - np.log(2) - weighted)
                now[level] = keys, weighted, zeros, ones
                self.keys[d, level] = keys
                self.one[d, level] = ((ones + 0.5) / (both + 1)).astype(np.float32)
                self.stop[d, level] = stop.astype(np.float32)
            below = now
        self.known = []
        for d in range(depth, max(depth - 3, -1), -1):
            codes = tables[d][0]
            values = [self._walk(codes[i:i + 100_000], d) for i in range(0, len(codes), 100_000)]
            self.known.append((d, codes, np.unique(codes >> np.uint64(8)), np.concatenate(values or [np.empty(0)]).astype(np.float32)))

    def _walk(self, codes: np.ndarray, depth: int) -> np.ndarray:
        """log10 of the probability of each code's byte: the mixture over depths, bit by bit, from ``depth`` on.

        A context that training has not seen has no share; its parent's estimate stands alone.
        """
        total = np.zeros(len(codes))
        for level in range(8):
            bit = ((codes >> np.uint64(7 - level)) & np.uint64(1)).astype(bool)
            p, begun = np.full(len(codes), 0.5), np.zeros(len(codes), bool)
            for d in range(depth, -1, -1):
                at, hit = find(self.keys[d, level], (codes & _mask(d)) >> np.uint64(8 - level))
                if not hit.any():
                    continue
                own = self.one[d, level][at].astype(float)
                own = np.where(bit, own, 1 - own)
                stop = np.where(begun, self.stop[d, level][at], 1.0)
                p = np.where(hit, stop * own + (1 - stop) * p, p)
                begun |= hit
            total += np.log10(p)
        return total

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 of the probability of each code's byte after its context.

        A code that training has seen is looked up. One whose context is unknown at a depth is that of the next shorter
        context; only unseen bytes after known contexts are worked out.
        """
        few, back = np.unique(codes, return_inverse=True)
        out, open_ = np.zeros(len(few)), np.arange(len(few))
        for d, table, contexts, known in self.known:
            asked = few[open_] & _mask(d)
            at, hit = find(table, asked)
            out[open_[hit]] = known[at[hit]] if len(known) else 0
            _, seen = find(contexts, asked >> np.uint64(8))
            new = seen & ~hit
            if new.any():
                out[open_[new]] = self._walk(few[open_[new]], d)
            open_ = open_[~seen]
        if len(open_):
            out[open_] = self._walk(few[open_], self.known[-1][0])
        return out[back]


def _count_words(batches):
    """How often training documents have a word; words of other documents are listed too."""
    seen, held = [], 0
    for b in batches:
        train = b.column("train").to_numpy(zero_copy_only=False).astype(bool)
        for text, words, at in lower_words(b.column("body")):
            seen.append(pa.table({"word": words, "c": np.bincount(at[train[text]], minlength=len(words))}))
            held += len(words)
            if held > 2 * _FLUSH:
                yield from _summed(seen)
                seen, held = [], 0
    if seen:
        yield from _summed(seen)


def _summed(seen: list[pa.Table]):
    """Each word of a few tables once."""
    return pa.concat_tables(seen).group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"]).to_batches(50_000)


def _add(table: list | None, codes: np.ndarray, n: np.ndarray, m: np.ndarray) -> list:
    """``[codes, n, m]`` with the counts of more codes, sorted and distinct: those of known codes are added in place, and
    new codes inserted column by column, so that little but the table itself is held twice."""
    if table is None:
        return [codes, n, m]
    at = np.searchsorted(table[0], codes)
    np.minimum(at, len(table[0]) - 1, out=at)
    hit = table[0][at] == codes
    for held, more in zip(table[1:], (n, m)):
        held[at[hit]] += more[hit]
    new = ~hit
    at, codes, n, m = at[new], codes[new], n[new], m[new]
    at += codes > table[0][at]  # behind the last one
    for k, more in enumerate((codes, n, m)):
        table[k] = np.insert(table[k], at, more)
    return table


def _count_grams(depth: int):
    """How often training documents (n) and all documents (m) have a code; each code of a few stretches is listed once."""
    def run(batches):
        table, held = None, 0
        for b in batches:
            train = b.column("train").to_numpy(zero_copy_only=False).astype(bool)
            for learn in (True, False):
                bodies = compress(b.column("body"), train == learn)
                for _, codes, begin, size in coded((x.as_py() for x in bodies), depth):
                    codes = _inside(codes, begin, size)
                    held += len(codes)
                    few, m = np.unique(codes, return_counts=True)
                    del codes
                    m = m.astype(np.int32)
                    table = _add(table, few, m.copy() if learn else np.zeros_like(m), m)
                    if len(table[0]) > 2_250_000 or held > _COUNTED:
                        yield from _grams(*table)
                        table, held = None, 0
        if table is not None:
            yield from _grams(*table)
    return run


def _inside(codes: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Those of a stretch's codes that belong to a text."""
    if len(begin) == 1:
        return codes[begin[0]:begin[0] + size[0]]
    return np.concatenate([codes[at:to] for at, to in zip(begin.tolist(), (begin + size).tolist())])


def _grams(codes, n, m):
    for at in range(0, len(codes), 50_000):
        part = slice(at, at + 50_000)
        yield pa.RecordBatch.from_arrays([pa.array(codes[part].view(np.int64)), *[pa.array(x[part].astype(np.int64)) for x in (n, m)]], names=["code", "n", "m"])


def _nodes(table: np.ndarray, level: int):
    """Of sorted codes the first and the node of each under the first ``level`` bits of the byte."""
    prefix = table >> np.uint64(8 - level)
    first = np.concatenate([[True], prefix[1:] != prefix[:-1]])
    return np.flatnonzero(first), np.cumsum(first) - 1


def _mix(p: np.ndarray, bit, known, own, stop) -> np.ndarray:
    """Probability of a bit with one depth more, the next shorter one; -1 stands for no known context so far."""
    own = np.where(bit, own, 1 - own)
    stop = np.where(p >= 0, stop, 1.0)
    return np.where(known, stop * own + (1 - stop) * p, p)


def lower_trees(codes: np.ndarray, n: np.ndarray, depth: int, root: int):
    """Per code, sorted and distinct, the probabilities of its eight bits from the depths ``root`` and more, -1 where training
    has seen none of these contexts; and ``(key, zeros, ones, log)`` of the nodes of depth ``root``, summed for each node
    of the next shorter context.

    A code that training has not seen has a count of 0; such codes change no node.
    """
    table, n, at = codes, n.astype(float), np.arange(len(codes))
    p = np.full((8, len(codes)), -1.0)
    below, up, above = [], None, []
    for d in range(depth, root - 1, -1):
        if d < depth:
            table, up = np.unique(table & _mask(d), return_inverse=True)
            n, at = np.bincount(up, n, len(table)), up[at]
        now = []
        for level in range(8):
            begin, node = _nodes(table, level)
            bit = (table >> np.uint64(7 - level)) & np.uint64(1)
            both, ones = np.add.reduceat(n, begin), np.add.reduceat(n * bit, begin)
            weighted = own = log_kt(both - ones, ones)
            stop = np.ones(len(own))
            if d < depth:
                first, deeper = below[level]
                weighted = np.logaddexp(own, np.bincount(node[up[first]], deeper, len(own))) - np.log(2)
                stop = np.exp(own - np.log(2) - weighted)
            here = node[at]
            p[level] = _mix(p[level], bit[at] > 0, (both > 0)[here], ((ones + 0.5) / (both + 1))[here], stop[here])
            now.append((begin, weighted))
            if d == root and root:
                seen = both > 0
                code = table[begin[seen]]
                key = (code & _mask(root - 1) & ~np.uint64(255)) | np.uint64(1 << level) | ((code & np.uint64(255)) >> np.uint64(8 - level))
                above.append((key, (both - ones)[seen], ones[seen], weighted[seen]))
        below = now
    if not above:
        return p.T, tuple(np.empty(0, k) for k in (np.uint64, float, float, float))
    key, *sums = (np.concatenate(x) for x in zip(*above))
    few, where = np.unique(key, return_inverse=True)
    return p.T, (few, *(np.bincount(where, x, len(few)) for x in sums))


def _lower(depth: int, root: int):
    """A row per code with the probabilities of its bits, and a row per node above; a task has all codes of its trees."""
    def run(batches):
        parts = [[b.column(c).to_numpy() for c in ("code", "n", "m")] for b in batches if b.num_rows]
        if not parts:
            return
        codes, n, m = (np.concatenate(x) for x in zip(*parts))
        del parts
        codes = codes.view(np.uint64)
        tree = codes & _mask(root) & ~np.uint64(255)
        order = np.argsort(tree, kind="stable")
        codes, n, m, tree = codes[order], n[order], m[order], tree[order]
        edges = np.append(np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])), len(codes))
        at = 0
        while at < len(codes):
            end = int(edges[max(np.searchsorted(edges, at + _SLICE, "right") - 1, np.searchsorted(edges, at, "right"))])
            sort = at + np.argsort(codes[at:end])
            p, nodes = lower_trees(codes[sort], n[sort], depth, root)
            yield from _bits(codes[sort], m[sort], p)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(nodes[0]), k) for k in (pa.int64(), pa.int64(), pa.binary())] + [pa.array(nodes[0].view(np.int64)), *[pa.array(x, pa.float64()) for x in nodes[1:]]], names=_LOWER)
            at = end
    return run


_LOWER = ["code", "m", "p", "node", "zeros", "ones", "log"]


def _bits(codes, m, p):
    for at in range(0, len(codes), 50_000):
        part = np.ascontiguousarray(p[at:at + 50_000], np.float32)
        size = len(part)
        packed = pa.Array.from_buffers(pa.binary(), size, [None, pa.py_buffer(np.arange(0, 32 * size + 1, 32, dtype=np.int32)), pa.py_buffer(part)])
        rest = [pa.nulls(size, k) for k in (pa.int64(), pa.float64(), pa.float64(), pa.float64())]
        yield pa.RecordBatch.from_arrays([pa.array(codes[at:at + size].view(np.int64)), pa.array(m[at:at + size]), packed, *rest], names=_LOWER)


def upper_trees(key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, children: np.ndarray, root: int) -> list[tuple]:
    """Per depth from ``root - 1`` to 0 its nodes: sorted keys, probability of a one, share of the node's own estimate."""
    out = []
    for d in range(root - 1, -1, -1):
        if d < root - 1:
            key = key & (_mask(d) & ~np.uint64(255) | np.uint64(255))
        key, at = np.unique(key, return_inverse=True)
        zeros, ones, children = (np.bincount(at, x, len(key)) for x in (zeros, ones, children))
        own = log_kt(zeros, ones)
        weighted = np.logaddexp(own, children) - np.log(2)
        out.append((key, (ones + 0.5) / (zeros + ones + 1), np.exp(own - np.log(2) - weighted)))
        children = weighted
    return out


def finish(codes: np.ndarray, p: np.ndarray, upper: list[tuple]) -> np.ndarray:
    """log10 of the probability of each code's byte, from that of its bits in the longer contexts and the upper nodes."""
    total = np.zeros(len(codes))
    for level in range(8):
        bit = ((codes >> np.uint64(7 - level)) & np.uint64(1)).astype(bool)
        q = p[:, level].astype(float)
        low = np.uint64(1 << level) | ((codes & np.uint64(255)) >> np.uint64(8 - level))
        for back, (keys, one, stop) in enumerate(upper):
            at, hit = find(keys, (codes & _mask(len(upper) - 1 - back) & ~np.uint64(255)) | low)
            if hit.any():
                q = _mix(q, bit, hit, one[at], stop[at])
        total += np.log10(np.where(q >= 0, q, 0.5))
    return total


def _finish(upper: Broadcast):
    def run(batches):
        for b in batches:
            if b.num_rows:
                codes = b.column("code").to_numpy().view(np.uint64)
                p = np.frombuffer(b"".join(b.column("p").to_pylist()), np.float32).reshape(-1, 8)
                yield pa.RecordBatch.from_arrays([b.column("code"), b.column("m"), pa.array(finish(codes, p, upper.value))], names=["code", "m", "value"])
    return run


def _from_tree(tree: Broadcast):
    def run(batches):
        for b in batches:
            values = tree.value.log10(b.column("code").to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([b.column("code"), b.column("m"), pa.array(values)], names=["code", "m", "value"])
    return run


def code_values(grams: DataFrame, depth: int, most_pairs: int | None = None) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """A held table with ``code, m`` of all codes, and what gives rows of it their ``value``: the log10-probability.

    ``grams`` has a code once, with its count ``n`` in training and ``m`` overall. With ``most_pairs`` the model is one of
    bounded size instead, as :func:`grow` cuts it.
    """
    spark = grams.sparkSession
    if most_pairs is not None:
        grams = hold(grams, "ctw-grams")
        tree = spark.sparkContext.broadcast(grow(grams.where("n > 0").select("code", "n"), depth, most_pairs))
        return grams, lambda rows: rows.select("code", "m").mapInArrow(_from_tree(tree), "code long, m long, value double")
    root = min(ROOT, depth)
    context = F.col("code").bitwiseAND(F.lit(((1 << 8 * root) - 1) << 8))
    lower = hold(grams.repartition(context).mapInArrow(
        tidy(_lower(depth, root)), "code long, m long, p binary, node long, zeros double, ones double, log double"), "ctw-lower")
    nodes = lower.where("node is not null").groupBy("node").agg(*[F.sum(c).alias(c) for c in _LOWER[4:]]).toArrow()  # bounded by the contexts of ROOT - 1 bytes
    upper = upper_trees(nodes["node"].to_numpy().view(np.uint64), *(nodes[c].to_numpy() for c in _LOWER[4:]), root)
    shared = spark.sparkContext.broadcast(upper)
    return lower.where("code is not null"), lambda rows: rows.select("code", "m", "p").mapInArrow(_finish(shared), "code long, m long, value double")


_PARTS = "row long, word binary, code long, n long, id long, held_out boolean, n_tokens long, n_known long, base double, score double"


def _look_up(head: Broadcast, known: Broadcast, depth: int, base: Callable, end: tuple[float, bool]):
    """A row per document with what its frequent codes and words and its end give, and a row per other code or word of it."""
    from pyspark import TaskContext

    def run(batches):
        top: Frequent = head.value
        place, more = Places(top.words), Slots(top.hashes)
        own_seen, own_base, more_seen, more_base = (x for c in (top.numbers, top.more) for x in ((c > 0).astype(np.int64), base(c)))
        table, value = known.value
        slots = Slots(table)
        row = (TaskContext.get().partitionId() << 36) + 1
        for b in batches:
            score = np.zeros(b.num_rows)
            for texts, codes, begin, size in coded((x.as_py() for x in b.column("body")), depth, _CHUNK >> 1):
                codes, text = _inside(codes, begin, size), np.repeat(np.array(texts, np.int32), size)
                at, hit = slots.find(codes)
                rare = np.flatnonzero(~hit)
                if len(table):
                    here = value[at]
                    here[rare] = 0
                    score += np.bincount(text, here, b.num_rows)
                if len(rare):
                    few, back = np.unique(codes[rare], return_inverse=True)
                    pair, n = np.unique(text[rare].astype(np.int64) * len(few) + back, return_counts=True)
                    yield _parts(len(n), row=row + pair // len(few), code=few[pair % len(few)].view(np.int64), n=n)
            tokens, seen, total = np.ones(b.num_rows, np.int64), np.full(b.num_rows, int(end[1])), np.full(b.num_rows, end[0])
            for text, words, at in lower_words(b.column("body")):
                words = words.to_numpy(zero_copy_only=False).tolist()
                here = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                own, left = here >= 0, np.flatnonzero(here < 0)
                word_seen, word_base = np.zeros(len(words)), np.zeros(len(words))
                word_seen[own], word_base[own] = own_seen[here[own]], own_base[here[own]]
                here, hit = more.find(hashes([words[k] for k in left.tolist()]))
                word_seen[left[hit]], word_base[left[hit]] = more_seen[here[hit]], more_base[here[hit]]
                tokens += np.bincount(text, minlength=b.num_rows)
                seen += np.bincount(text, word_seen[at], b.num_rows).astype(np.int64)
                total += np.bincount(text, word_base[at], b.num_rows)
                own[left[hit]] = True
                rare = np.flatnonzero(~own[at])
                pair, n = np.unique(text[rare].astype(np.int64) * len(words) + at[rare], return_counts=True)
                for k in range(0, len(n), 50_000):
                    some, times = pair[k:k + 50_000], n[k:k + 50_000]
                    yield _parts(len(times), row=row + some // len(words), word=[words[w] for w in (some % len(words)).tolist()], n=times)
            yield _parts(b.num_rows, row=row + np.arange(b.num_rows), id=b.column("id"), held_out=b.column("held_out"), n_tokens=tokens, n_known=seen, base=total, score=score)
            row += b.num_rows
    return run


_KINDS = {"row": pa.int64(), "word": pa.binary(), "code": pa.int64(), "n": pa.int64(), "id": pa.int64(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "score": pa.float64()}


def _parts(size: int, **have):
    return pa.RecordBatch.from_arrays([pa.array(have[c], k) if c in have else pa.nulls(size, k) for c, k in _KINDS.items()], names=list(_KINDS))


def grow(grams: DataFrame, depth: int, most: int) -> Tree:
    """The tree from counts per code; contexts beyond ``most`` pairs of a depth are left to their shorter contexts."""
    pruned, full = {}, depth
    grams = hold(grams, "ctw-grams")
    while full and grams.count() > most:
        ctx = grams.groupBy(F.shiftright("code", 8).alias("ctx")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("pairs"))
        sizes = {r["size"]: r["pairs"] for r in ctx.groupBy(F.floor(F.log2("total")).alias("size")).agg(F.sum("pairs").alias("pairs")).collect()}  # a row per power of two
        least, held = 64, 0
        for s in sorted(sizes, reverse=True):
            if held + sizes[s] > most:
                break
            least, held = s, held + sizes[s]
        kept = grams.join(ctx.where(F.col("total") >= F.lit(2.0) ** least).select("ctx"), F.shiftright("code", 8) == F.col("ctx")).select("code", "n").toArrow()
        pruned[full] = kept["code"].to_numpy().view(np.uint64), kept["n"].to_numpy().astype(float)
        full -= 1
        grams = hold(grams.groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (full + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n")), "ctw-grams")
    table = grams.toArrow()
    codes, counts = table["code"].to_numpy().view(np.uint64), table["n"].to_numpy().astype(float)
    return Tree(codes, counts, depth, full, pruned)


def score(
    docs: DataFrame, held_out: Column, depth: int = DEPTH, id_col: str = "doc_id", text_col: str = "text",
    head: int = HEAD, most_pairs: int | None = None, head_codes: int = HEAD_CODES, more: int = MORE,
) -> DataFrame:
    """Per row of ``docs``: ``id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out`` is a boolean expression over ``docs``; the model learns from the rows where it is false. Tokens are the
    words, A-Z in lower case, and one end. ``base_score`` is the log10-probability under smoothed token counts, ``score``
    that of the same tokens under the context trees; ``-score`` per byte is the code length. Null text is empty: the end
    alone. Without training rows every bit costs one bit. Rows that repeat are scored each; a null id stays null.
    The model has all that training has seen, unless ``most_pairs`` asks for one of bounded size. ``head``, ``more`` and
    ``head_codes`` say how many words, words by hash, and codes are looked up in memory instead of joined; results do not
    depend on them.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), body.alias("body"))
    counted = rows.select("body", (~F.col("held_out")).alias("train")).mapInArrow(tidy(_count_words), "word binary, c long")
    with text_batches(spark):
        words = hold(counted.groupBy("word").agg(F.sum("c").alias("c")), "ctw-words")
    total, kinds = words.where("c > 0").agg(F.sum("c"), F.count(F.lit(1))).first()
    ends = rows.where(~F.col("held_out")).count()
    n, v = (total or 0) + ends, kinds + (ends > 0)

    grams = rows.select("body", (~F.col("held_out")).alias("train")).mapInArrow(tidy(_count_grams(depth)), "code long, n long, m long")
    with text_batches(spark):
        codes, valued = code_values(grams.groupBy("code").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), depth, most_pairs)
    least, _ = least_count(codes, "m", head_codes)
    table = valued(codes.where(F.col("m") >= least)).select("code", "value").toArrow()  # head_codes at most
    sort = np.argsort(table["code"].to_numpy().view(np.uint64))
    known = spark.sparkContext.broadcast((table["code"].to_numpy().view(np.uint64)[sort], table["value"].to_numpy()[sort]))

    def base(c):
        return np.log10((c + 0.5) / (n + 0.5 * (v + 1)))

    top = spark.sparkContext.broadcast(frequent(words, "c", "c", head, more))
    with text_batches(spark):
        parts = hold(rows.mapInArrow(tidy(_look_up(top, known, depth, base, (float(base(ends)), ends > 0))), _PARTS), "ctw-parts")
    rare = F.log10((F.col("c") + 0.5) / F.lit(n + 0.5 * (v + 1)))
    own = parts.where("n is null").select("row", "id", "held_out", "n_tokens", "n_known", "base", "score")
    nothing = [F.lit(None).cast("long").alias("id"), F.lit(None).cast("boolean").alias("held_out")]
    by_word = parts.where("word is not null").select("row", "word", "n").join(words, "word").select(
        "row", *nothing, F.lit(0).alias("n_tokens"), F.when(F.col("c") > 0, F.col("n")).otherwise(0).alias("n_known"), (F.col("n") * rare).alias("base"), F.lit(0.0).alias("score"))
    by_code = parts.where("code is not null").select("row", "code", "n").join(valued(codes.where(F.col("m") < least)).select("code", "value"), "code").select(
        "row", *nothing, F.lit(0).alias("n_tokens"), F.lit(0).alias("n_known"), F.lit(0.0).alias("base"), (F.col("n") * F.col("value")).alias("score"))
    return own.unionByName(by_word).unionByName(by_code).groupBy("row").agg(
        F.max("id").alias("id"), F.max("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score")).select(
        "id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
