"""Toxicity by two class-conditional Kneser-Ney models.

Both models predict the bytes of a word from the bytes before them in the word. Their highest order has the counts of its
own class (documents that have the word) with a discount of one; below it both share one hierarchy of continuation counts
over both classes, so an expression that neither class has seen often costs the same under both and only evidence from
several documents separates them. A document is compared by the difference of its two log-likelihoods per byte, and by
the same difference of its most telling words; a logistic curve, fitted on labelled documents that the counts leave out,
turns these into a score.

All n-grams of the labelled sample are a table. Each distinct word of the texts gets its difference once: n-grams of frequent
contexts are looked up in memory, all others joined. Texts find frequent words in memory, most of them by a hash, and the
others by a join.
"""

from __future__ import annotations

from collections import Counter
from itertools import compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frequent import HEAD, MORE, Frequent, Places, frequent, hashes
from .staging import discard, hold, text_batches, tidy
from .words import Slots, find, runs, word_grams

#: Bytes that a byte is predicted from, and one.
ORDER = 7
#: Labelled documents that are used at most, and n-grams that tasks look up in memory (those of the most frequent contexts).
MOST_LABELS, MOST_GRAMS = 200_000, 1_000_000
#: A word counts as telling from this difference on (nats).
TELLING = 3.0
_FLUSH = 200_000


def _discount(counts: np.ndarray) -> float:
    return _share(np.count_nonzero(counts == 1), np.count_nonzero(counts == 2))


def _share(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once and twice else 0.5


def _by_context(codes: np.ndarray, counts: np.ndarray):
    """Contexts, the context of each code, and per context the sum of counts and the codes with a count."""
    contexts, at = np.unique(codes >> np.uint64(8), return_inverse=True)
    return contexts, at, np.bincount(at, counts, len(contexts)), np.bincount(at, counts > 0, len(contexts))


def _levels(codes: np.ndarray, order: int, least: int = 1) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per order from ``least`` to ``order - 1`` the distinct codes and how many codes of one byte more continue each."""
    out, longer = {}, codes
    for m in range(order - 1, least - 1, -1):
        kept, n = np.unique(longer & np.uint64((1 << 8 * m) - 1), return_counts=True)
        out[m] = kept, n.astype(float)
        longer = kept
    return out


class Backoff(NamedTuple):
    """The lowest orders, which all contexts share: codes of ``SHARED`` bytes, their probabilities, and the discounts above."""

    codes: np.ndarray
    p: np.ndarray
    discounts: dict[int, float]


def shared_backoff(codes: np.ndarray, order: int = ORDER, start: Backoff | None = None) -> np.ndarray:
    """For each code (distinct, both classes) the Kneser-Ney probability of its byte after one context byte less.

    With ``start``, ``codes`` may be those of some contexts alone.
    """
    below, p, first = (start.codes, start.p, SHARED + 1) if start else (np.zeros(1, np.uint64), np.full(1, 1 / 256), 1)
    levels = _levels(codes, order, first)
    for m in range(first, order):
        kept, count = levels[m]
        d = start.discounts[m] if start else _discount(count)
        _, at, total, kinds = _by_context(kept, count)
        lower = p[np.searchsorted(below, kept & np.uint64((1 << 8 * (m - 1)) - 1))] if m > 1 else p[0]
        p = np.maximum(count - d, 0) / total[at] + d * kinds[at] / total[at] * lower
        below = kept
    return p[np.searchsorted(below, codes & np.uint64((1 << 8 * (order - 1)) - 1))]


class Model:
    """Difference of the log-probabilities (class 1 less class 0) of a byte after its context."""

    def __init__(self, codes: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray, order: int = ORDER, start: Backoff | None = None):
        self.order = order
        sort = np.argsort(codes)
        self.codes = codes[sort]
        shared = shared_backoff(self.codes, order, start) if len(codes) else np.empty(0)
        seen, unseen = [], []
        for counts in (ordinary[sort].astype(float), toxic[sort].astype(float)):
            d = 1.0  # what one document alone has shown counts as unseen
            contexts, at, total, kinds = _by_context(self.codes, counts)
            with np.errstate(divide="ignore", invalid="ignore"):
                rest = np.where(total > 0, d * kinds / total, 1.0)
                own = np.where(total[at] > 0, np.maximum(counts - d, 0) / total[at], 0)
            seen.append(np.log(own + rest[at] * shared))
            unseen.append(np.log(rest))
        self.contexts = contexts
        self.seen = (seen[1] - seen[0]).astype(np.float32)
        self.unseen = (unseen[1] - unseen[0]).astype(np.float32)

    def of_words(self, words: list[bytes]) -> np.ndarray:
        """The difference of each word, summed over its bytes and its end."""
        out = np.zeros(len(words))
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            codes, word = word_grams(part, self.order)
            few, back = np.unique(codes, return_inverse=True)
            i, hit = find(self.codes, few)
            j, known = find(self.contexts, few >> np.uint64(8))
            value = np.where(hit, self.seen[i], np.where(known, self.unseen[j], 0)) if len(self.codes) else np.zeros(len(few))
            out[at:at + len(part)] = np.bincount(word, value[back], len(part))
        return out


#: Features of a text: difference per byte; the three largest of its distinct words; what the distinct words have above
#: ``TELLING`` in all, and relative to the root of their number; the logarithm of that number. All 0 without words.
FEATURES = 7
#: Orders that are worked out for all contexts together; above, a task has all n-grams of its contexts.
SHARED = 2


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Scale of the features and weights (intercept last) of a logistic curve, by reweighted least squares."""
    scale = np.abs(x).max(axis=0, initial=0)
    scale = np.where(scale > 0, scale, 1.0)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        r = p * (1 - p) + 1e-9
        step = np.linalg.solve((z * r[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return scale, w


def fold(ident: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 for a null id."""
    return F.coalesce(F.crc32(ident.cast("string").cast("binary")) % 5, F.lit(0))


def _count_words(batches):
    """Documents of each class that have a word."""
    seen = (Counter(), Counter())

    def rows():
        words = list(set(seen[0]) | set(seen[1]))
        return pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), *[pa.array([c[w] for w in words], pa.int64()) for c in seen]], names=["word", "n0", "n1"])

    for b in batches:
        for body, y in zip(b.column("body"), b.column("toxic").to_pylist()):
            seen[y].update({w for ws in runs(body.as_py().lower()) for w in ws})
            if len(seen[0]) + len(seen[1]) > _FLUSH:
                yield rows()
                seen = (Counter(), Counter())
    yield rows()


def _count_grams(batches):
    for b in batches:
        words = b.column("word").to_pylist()
        n = [b.column(c).to_numpy() for c in ("n0", "n1")]
        for at in range(0, len(words), 50_000):
            codes, word = word_grams(words[at:at + 50_000], ORDER)
            few, back = np.unique(codes, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(few.view(np.int64)), *[pa.array(np.bincount(back, x[at:at + 50_000][word]).astype(np.int64)) for x in n]],
                names=["code", "n0", "n1"])


def _continuations(batches):
    """Per order above ``SHARED`` how many codes are continued once and twice, and how often each code of ``SHARED`` bytes is."""
    parts = [b.column("code").to_numpy() for b in batches if b.num_rows]
    if parts:
        levels = _levels(np.concatenate(parts).view(np.uint64), ORDER, SHARED)
        for m, (kept, n) in levels.items():
            low = m == SHARED
            code, once, twice = (kept, n, n * 0) if low else ([0], [np.count_nonzero(n == 1)], [np.count_nonzero(n == 2)])
            yield pa.RecordBatch.from_arrays([pa.array([m] * len(code), pa.int32()), *[pa.array(np.asarray(x).astype(np.int64)) for x in (code, once, twice)]],
                                             names=["size", "code", "once", "twice"])


def _differences(start: Broadcast):
    """A row per n-gram and one per context (no code) with its difference; both have the documents of the context."""
    def run(batches):
        parts = [[b.column(c).to_numpy() for c in ("code", "n0", "n1")] for b in batches if b.num_rows]
        if parts:
            codes, n0, n1 = (np.concatenate(x) for x in zip(*parts))
            codes = codes.view(np.uint64)
            model = Model(codes, n0, n1, ORDER, start.value)
            _, at, total, kinds = _by_context(model.codes, (n0 + n1)[np.argsort(codes)])
            for context, code, value, docs, grams in (
                    (model.contexts[at], pa.array(model.codes.view(np.int64)), model.seen, total[at], 1),
                    (model.contexts, pa.nulls(len(model.contexts), pa.int64()), model.unseen, total, 0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(context.view(np.int64)), code, pa.array(value.astype(float)), pa.array(docs.astype(np.int64)), pa.array(np.full(len(context), grams, np.int64))],
                    names=["context", "code", "value", "docs", "grams"])
    return run


class Differences(NamedTuple):
    """The differences of all n-grams as a table, those of frequent contexts as a broadcast, and what the latter lacks."""

    head: Broadcast
    rest: DataFrame | None


def learn(grams: DataFrame, most_grams: int = MOST_GRAMS) -> Differences:
    """The model of all ``grams`` (``code, n0, n1``); the most frequent contexts, up to ``most_grams`` n-grams, in memory."""
    spark = grams.sparkSession
    with text_batches(spark):
        grams = hold(grams, "toxicity-grams")
    dealt = grams.repartition(F.col("code").bitwiseAND(F.lit(((1 << 8 * SHARED) - 1) << 8)))
    rows = dealt.select("code").mapInArrow(tidy(_continuations), "size int, code long, once long, twice long").groupBy("size", "code").agg(
        F.sum("once").alias("once"), F.sum("twice").alias("twice")).toArrow().sort_by("code")  # 256 ^ SHARED rows at most
    size, code, once, twice = (rows[c].to_numpy() for c in rows.column_names)
    low = size == SHARED
    below, count = code[low].view(np.uint64), once[low].astype(float)
    levels = _levels(below, SHARED) | {SHARED: (below, count)}
    p, codes = np.full(1, 1 / 256), np.zeros(1, np.uint64)
    for m in range(1, SHARED + 1) if len(below) else ():
        kept, n = levels[m]
        d = _discount(n)
        _, at, total, kinds = _by_context(kept, n)
        lower = p[np.searchsorted(codes, kept & np.uint64((1 << 8 * (m - 1)) - 1))] if m > 1 else p[0]
        p = np.maximum(n - d, 0) / total[at] + d * kinds[at] / total[at] * lower
        codes = kept
    discounts = {m: _share(int(once[size == m].sum()), int(twice[size == m].sum())) for m in range(SHARED + 1, ORDER)}
    start = spark.sparkContext.broadcast(Backoff(codes, p, discounts))
    table = hold(dealt.mapInArrow(tidy(_differences(start)), "context long, code long, value double, docs long, grams long"), "toxicity-differences")
    discard(grams)
    sizes = {r["size"]: r for r in table.groupBy(F.floor(F.log2("docs") * 8).alias("size")).agg(F.sum("grams").alias("grams"), F.min("docs").alias("least")).collect()}  # eight rows per power of two
    least, held, whole = 1 << 62, 0, True
    for k in sorted(sizes, reverse=True):
        held += sizes[k]["grams"]
        if held > most_grams:
            whole = False
            break
        least = sizes[k]["least"]
    head = table.where(F.col("docs") >= least).select("context", "code", "value").toArrow().sort_by([("context", "ascending")])
    known = head["code"].is_valid().to_numpy()
    seen = _sorted(head["code"].filter(pa.array(known)).to_numpy(), head["value"].to_numpy()[known])
    contexts = _sorted(head["context"].to_numpy()[~known], head["value"].to_numpy()[~known])
    return Differences(spark.sparkContext.broadcast((*seen, *contexts)), None if whole else table.where(F.col("docs") < least))


def _sorted(codes, values):
    sort = np.argsort(codes.view(np.uint64))
    return codes.view(np.uint64)[sort], values[sort]


def _list_words(batches):
    """Texts that have a word."""
    seen: Counter = Counter()

    def rows():
        return pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    for b in batches:
        for body in b.column("body"):
            seen.update({w for ws in runs(body.as_py().lower()) for w in ws})
            if len(seen) > _FLUSH:
                yield rows()
                seen = Counter()
    yield rows()


def _sum_words(head: Broadcast, whole: bool):
    """A row per word with what its n-grams of frequent contexts give, and unless these are all a row per other n-gram."""
    def run(batches):
        codes, seen, contexts, unseen = head.value
        for b in batches:
            words, number = b.column("word").to_pylist(), b.column("number").to_numpy()
            for k in range(0, len(words), 50_000):
                part = words[k:k + 50_000]
                asked, word = word_grams(part, ORDER)
                few, back = np.unique(asked, return_inverse=True)
                at, known = find(contexts, few >> np.uint64(8))
                value = np.zeros(len(few))
                if known.any():
                    i, hit = find(codes, few)
                    value = np.where(hit, seen[i], np.where(known, unseen[at], 0))
                sums = np.bincount(word, value[back], len(part))
                yield pa.RecordBatch.from_arrays([pa.array(number[k:k + 50_000]), pa.nulls(len(part), pa.int64()), pa.array(sums)], names=["number", "code", "value"])
                open_ = ~known[back]
                if not whole and open_.any():
                    yield pa.RecordBatch.from_arrays([pa.array(number[k:k + 50_000][word[open_]]), pa.array(asked[open_].view(np.int64)), pa.nulls(int(open_.sum()), pa.float64())],
                                                     names=["number", "code", "value"])
    return run


def word_values(words: DataFrame, model: Differences) -> DataFrame:
    """``word, n, value`` as a held table: the difference of each word of ``words`` (``word, n``), summed over its bytes and
    its end."""
    with text_batches(words.sparkSession):
        words = hold(words.withColumn("number", F.monotonically_increasing_id()), "toxicity-words")
    sums = words.mapInArrow(tidy(_sum_words(model.head, model.rest is None)), "number long, code long, value double")
    if model.rest is None:
        values = hold(words.join(sums.select("number", "value"), "number").select("word", "n", "value"), "toxicity-values")
        discard(words)
        return values
    sums = hold(sums, "toxicity-sums")
    seen = model.rest.where("code is not null").select("code", F.col("value").alias("seen"))
    unseen = model.rest.where("code is null").select("context", F.col("value").alias("unseen"))
    asked = sums.where("code is not null").select("code").distinct().withColumn("context", F.shiftrightunsigned("code", 8))
    found = asked.join(unseen, "context").join(seen, "code", "left").select("code", F.coalesce("seen", "unseen").alias("value"))  # other contexts give 0
    rest = sums.where("code is not null").select("number", "code").join(found, "code").select("number", "value")
    total = sums.where("code is null").select("number", "value").unionByName(rest).groupBy("number").agg(F.sum("value").alias("value"))
    values = hold(words.join(total, "number").select("word", "n", "value"), "toxicity-values")
    discard(words, sums)
    return values


def _look_up(head: Broadcast):
    """A row per text with what its frequent words give, and a row per other distinct word of it."""
    from pyspark import TaskContext

    kinds = {"row": pa.int64(), "word": pa.binary(), "n": pa.int64(), "total": pa.float64(), "size": pa.int64(), "top": pa.list_(pa.float64()), "telling": pa.float64(), "id": pa.int64()}

    def run(batches):
        top: Frequent = head.value
        place, slots = Places(top.words), Slots(top.hashes)
        value, more = np.append(top.numbers, 0.0), np.append(top.more, 0.0)
        row = TaskContext.get().partitionId() << 36
        own, group, words = [], [], []

        def others(carried):
            """Notes what the texts of the group have in memory; a row for each word that is not."""
            nonlocal row
            at, hit = slots.find(hashes(words))
            at = np.where(hit, at, -1)
            k, rows, counts = 0, [], []
            for seen, places in group:
                row += 1
                known, v, n = places >= 0, value[places], np.fromiter(seen.values(), np.int64, len(seen))
                rest = np.flatnonzero(~known)
                found = at[k:k + len(rest)]
                k += len(rest)
                v[rest], known[rest] = more[found], found >= 0
                size = np.fromiter(map(len, seen), np.int64, len(seen)) + 1
                rows.append(np.full(len(seen) - np.count_nonzero(known), row))
                counts.append(n[~known])
                v, n = v[known], n[known]
                own.append((row, None, len(v), float((v * n).sum()), int((size[known] * n).sum()), np.sort(v)[:-4:-1].tolist(), float(np.maximum(v - TELLING, 0).sum())))
            have = [pa.array(np.concatenate(rows)), pa.array(list(compress(words, ~hit)), pa.binary()), pa.array(np.concatenate(counts))]
            have += [pa.nulls(len(have[0]), k) for k in list(kinds.values())[3:]] + ([pa.nulls(len(have[0]), carried)] if carried is not None else [])
            group.clear()
            words.clear()
            return pa.RecordBatch.from_arrays(have, names=[*kinds] + ["carried"] * (carried is not None))

        for b in batches:
            carried = b.column("carried").type if "carried" in b.schema.names else None
            for body in b.column("body"):
                seen = Counter()
                for ws in runs(body.as_py().lower()):
                    seen.update(ws)
                at = np.fromiter(map(place.__getitem__, seen), np.int64, len(seen))
                group.append((seen, at))
                words.extend(compress(seen, at < 0))
                if len(words) > 20_000 or len(group) > 1_000:
                    yield others(carried)
            if group:
                yield others(carried)
            if own:
                columns = [pa.array(c, k) for c, k in zip(zip(*own), kinds.values())] + [b.column("id")]
                yield pa.RecordBatch.from_arrays(columns + ([b.column("carried")] if carried is not None else []), names=[*kinds] + ["carried"] * (carried is not None))
                own.clear()
    return run


def _features(rows: DataFrame, model: Differences, head: int = HEAD, more: int = MORE) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """``id, x`` and ``carried`` if there is one per row of ``rows`` (``id, body``); ``x`` are the features. And the held tables
    that these are read from."""
    spark = rows.sparkSession
    words = rows.select("body").mapInArrow(tidy(_list_words), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    values = word_values(words, model)
    top = spark.sparkContext.broadcast(frequent(values, "n", "value", head, more))
    carry = ["carried"] if "carried" in rows.columns else []
    extra = f", carried {rows.schema['carried'].dataType.simpleString()}" if carry else ""
    with text_batches(spark):
        parts = hold(rows.mapInArrow(
            tidy(_look_up(top)), f"row long, word binary, n long, total double, size long, top array<double>, telling double, id long{extra}"), "toxicity-parts")
    v, n = F.col("value"), F.col("k")
    rest = parts.where("word is not null").select("row", "word", F.col("n").alias("k")).join(values.select("word", "value"), "word").groupBy("row").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(v * n).alias("_total"), F.sum((F.octet_length("word") + 1) * n).alias("_size"),
        F.slice(F.sort_array(F.collect_list(v), False), 1, 3).alias("_top"), F.sum(F.greatest(v - TELLING, F.lit(0.0))).alias("_telling"))
    both = parts.where("word is null").join(rest, "row", "left")
    n, total, size, telling = (F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in ("n", "total", "size", "telling"))
    best = F.sort_array(F.concat("top", F.coalesce("_top", F.array().cast("array<double>"))), False)
    tops = [F.coalesce(F.get(best, F.lit(i)), F.lit(0.0)) for i in range(3)]
    x = F.array(total / F.greatest(size, F.lit(1)), *tops, telling, telling / F.sqrt(F.greatest(n, F.lit(1))), F.log1p(n))
    return both.select("id", x.alias("x"), *carry), (values, parts)


def _body(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b""))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        most_labels: int = MOST_LABELS, most_grams: int = MOST_GRAMS) -> tuple[Differences, np.ndarray, np.ndarray]:
    """The model and the logistic curve, from labelled documents outside fold 0: folds 2-4 are counted, fold 1 fits the
    curve.

    ``most_labels`` labelled documents are used, chosen by a hash of the id, with all their n-grams; ``most_grams`` of these
    are looked up in memory and the others joined, which changes no result. Null labels and ids are left out; an id with several labels has the largest.
    """
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("toxic")).where(
        "id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic")).where(fold(F.col("id")) != 0)
    n = known.count()
    if n > most_labels:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < int((1 << 20) * most_labels / n))
    known = F.broadcast(known.select("id", (F.col("toxic") > 0).cast("int").alias("toxic")))  # two numbers for each of most_labels
    train = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _body(text_col).alias("body")).join(known, "id")
    words = train.where(fold(F.col("id")) > 1).select("toxic", "body").mapInArrow(tidy(_count_words), "word binary, n0 long, n1 long")
    words = words.groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    grams = words.mapInArrow(tidy(_count_grams), "code long, n0 long, n1 long").groupBy("code").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    model = learn(grams, most_grams)
    fold_one = train.where(fold(F.col("id")) == 1).select("id", "body", F.struct("toxic").alias("carried"))
    features, held = _features(fold_one, model)
    rows = features.select("carried.toxic", "x").toArrow()
    discard(*held)
    y = rows["toxic"].to_numpy().astype(float)
    if len(y) and 0 < y.mean() < 1:
        scale, weights = logistic(np.array(rows["x"].to_pylist()), y)
    else:  # one class at most: its share, whatever the text
        scale, weights = np.ones(FEATURES), np.zeros(FEATURES + 1)
        weights[-1] = 30.0 if len(y) and y.mean() == 1 else -30.0
    return model, scale, weights


def score(docs: DataFrame, fitted: tuple[Differences, np.ndarray, np.ndarray], id_col: str = "doc_id", text_col: str = "text",
          carry: tuple[str, ...] = ()) -> DataFrame:
    """``id, score`` per row, from the whole text alone; null is empty and scores as a text without words. ``carry`` names
    columns that come along in a struct ``carried``."""
    model, scale, weights = fitted
    columns = [F.col(f"`{id_col}`").cast("long").alias("id"), _body(text_col).alias("body")]
    if carry:
        columns.append(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried"))
    z = F.lit(float(weights[-1]))
    for k in range(FEATURES):
        z = z + F.col("x")[k] * float(weights[k] / scale[k])
    z = F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))
    scored, _ = _features(docs.select(*columns), model)
    return scored.select("id", *["carried"] * bool(carry), (1 / (1 + F.exp(-z))).alias("score"))


def drop(docs: DataFrame, fitted: tuple[Differences, np.ndarray, np.ndarray], at_least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text scores below ``at_least``.

    A score depends on the text alone, so it is decided on the text's 128-bit hash: only hashes go through the scoring
    joins, and the documents meet the list of rejected hashes once, as they are. Null is empty; rows that repeat share
    their fate; an empty table stays empty.
    """
    text = _body(text_col)
    slim = docs.select(F.lit(0).alias("id"), text.alias("body"), F.unhex(F.md5(text)).alias("hash"))
    rejected = score(slim, fitted, "id", "body", carry=("hash",)).where(F.col("score") >= at_least)
    rejected = hold(rejected.select(F.col("carried.hash").alias("hash")).distinct(), "toxicity-rejected")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.unhex(F.md5(text)).alias("own"))
    return whole.join(rejected, F.col("own") == F.col("hash"), "left_anti").select("doc.*")
