import random
from collections import Counter
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from shelfseries.llm import toxicity
from shelfseries.llm.staging import shared_folder
from shelfseries.llm.words import word_grams


def test_held_out_accuracy(spark, medium):
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, F.col("id") == F.col("doc_id")).where(toxicity.fold(F.col("id")) == 0)
    rows = [(r["score"], r["toxic"]) for r in scored.collect()]
    pairs = [(a > b) + (a == b) / 2 for a, y in rows if y for b, z in rows if not z]
    assert np.mean(pairs) > 0.9
    caught = [s >= 0.5 for s, y in rows if y]
    kept = [s < 0.5 for s, y in rows if not y]
    assert sum(caught) >= 0.6 * len(caught) and sum(kept) >= 0.9 * len(kept)  # 6 and 64 documents; see test_pipeline for more


def test_odd_documents(make, odd, spark):
    docs = make(odd)
    labels = spark.createDataFrame([(i, None if i == 4 else i % 2, "x") for i in range(1, 23)] + [(None, 1, "y"), (1, 0, "z")], "doc_id long, toxic int, body string")
    rows = toxicity.score(docs, toxicity.fit(docs, labels), carry=("text", "id", "score")).collect()
    assert len(rows) == len(odd) and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if not (r["carried"]["text"] or "").strip()}
    assert len(blank) == 1
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r["score"] < 0.5 for r in toxicity.score(docs, none).collect())
    assert toxicity.score(make([]), none).count() == 0


def test_grams_end_in_each_byte():
    codes, word = word_grams([b"ab", b"", b"c"], 3)
    parts = [(int(c).to_bytes(3, "big"), int(w)) for c, w in zip(codes, word)]
    assert parts == [(b"\0 a", 0), (b" ab", 0), (b"ab ", 0), (b"\0  ", 1), (b"\0 c", 2), (b" c ", 2)]


def kneser_ney(grams, order, shared):
    """The whole model by dictionaries: ``{gram: (n0, n1)}`` of byte strings, longest order; a function of (context, byte)
    that gives both classes' probabilities. ``shared`` is the probability of the empty context."""
    levels = {order - 1: Counter(g[1:] for g in grams)}
    for m in range(order - 2, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    totals = {m: Counter() for m in levels}
    kinds = {m: Counter() for m in levels}
    discount = {}
    for m, counts in levels.items():
        once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
        discount[m] = once / (once + 2 * twice) if once and twice else 0.5
        for g, n in counts.items():
            totals[m][g[:-1]] += n
            kinds[m][g[:-1]] += 1

    def lower(context, byte):
        m = len(context) + 1
        if m == 0 or not context and not totals[1][b""]:
            return shared
        below = lower(context[1:], byte) if context else shared
        total = totals[m][context]
        if not total:
            return below
        return max(levels[m][context + byte] - discount[m], 0) / total + discount[m] * kinds[m][context] / total * below

    def both(context, byte):
        out = []
        for y in (0, 1):
            counts = {g: n[y] for g, n in grams.items() if g[:-1] == context}
            total = sum(counts.values())
            p = lower(context[1:], byte)
            out.append((max(counts.get(context + byte, 0) - 1, 0) + sum(n > 0 for n in counts.values()) * p) / total if total else p)
        return out
    return lower, both


def spelled(words, order):
    """Grams of ``order`` bytes that end in each byte of a word and its end, zeros before the word."""
    for w in words:
        text = b"\0" * (order - 2) + b" " + w + b" "
        yield [text[k - order + 1:k + 1] for k in range(order - 1, len(text))]


def test_model_against_dictionaries():
    r = random.Random(4)
    order = 4
    words = [bytes(r.choices(b"abc", k=r.randint(0, 6))) for _ in range(60)]
    grams = Counter()
    for k, found in enumerate(spelled(words, order)):
        for g in found:
            n = grams.get(g) or (0, 0)
            grams[g] = (n[0] + (k % 3 > 0), n[1] + (k % 3 != 1))
    codes = np.array([int.from_bytes(g, "big") for g in grams], np.uint64)
    model = toxicity.Model(codes, *(np.array([n[y] for n in grams.values()]) for y in (0, 1)), order)
    lower, both = kneser_ney(grams, order, 1 / 256)
    for g, p in zip(sorted(grams), toxicity.shared_backoff(np.sort(codes), order)):
        assert abs(lower(g[1:-1], g[-1:]) - p) < 1e-12
    for context in {g[1:-1] for g in grams}:
        assert abs(sum(lower(context, bytes([b])) for b in range(256)) - 1) < 1e-9
    for context in {g[:-1] for g in grams}:
        sums = np.sum([both(context, bytes([b])) for b in range(256)], axis=0)
        assert np.abs(sums - 1).max() < 1e-9
    asked = words[:10] + [b"abcabc", b"zzz", b"cz", b""]
    for w, value in zip(asked, model.of_words(asked)):
        (found,) = spelled([w], order)
        pairs = [both(g[:-1], g[-1:]) for g in found]
        assert abs(sum(np.log(p1) - np.log(p0) for p0, p1 in pairs) - value) < 1e-4


def test_no_ngram_is_dropped(spark, medium):
    """The bound is one of memory: scores do not depend on it, and differences are those of the model of all n-grams."""
    docs, labels = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "labels"))
    some, few = ({r["id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels, most_grams=most)).collect()} for most in (1_000_000, 2_000))
    assert some.keys() == few.keys() and all(abs(some[i] - few[i]) < 1e-9 for i in some)


def test_word_values_against_the_whole_model(spark):
    words = [b"abra", b"cadabra", b"abracadabra", b"bar", b"car", b"cart", b"scar"] * 3
    codes, word = word_grams(words, toxicity.ORDER)
    few, back = np.unique(codes, return_inverse=True)
    n0, n1 = np.bincount(back, word % 3), np.bincount(back, word % 2)
    asked = [b"abra", b"carbar", b"zzz", b"scart", b"cadab"]
    expected = toxicity.Model(few, n0, n1).of_words(asked)
    grams = spark.createDataFrame([(int(c), int(a), int(b)) for c, a, b in zip(few.view(np.int64), n0, n1)], "code long, n0 long, n1 long")
    listed = spark.createDataFrame([(bytearray(w), 1) for w in asked], "word binary, n long")
    for most in (1_000_000, 20, 0):
        got = {bytes(r["word"]): r["value"] for r in toxicity.word_values(listed, toxicity.learn(grams, most)).collect()}
        assert np.allclose([got[w] for w in asked], expected, atol=1e-6)


def test_fit_leaves_only_the_model_on_disk(make, odd, spark):
    """Tables that only the fit reads are gone after it; the score still has what it reads."""
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.glob("toxicity-*"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 23)], "doc_id long, toxic int")
    fitted = toxicity.fit(make(odd), labels, most_grams=50)
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("toxicity-*")) - before} == {"toxicity-differences"}
    scored = toxicity.score(make(odd), fitted)
    assert {p.name.rsplit("-", 1)[0] for p in set(folder.glob("toxicity-*")) - before} == {"toxicity-differences", "toxicity-values", "toxicity-parts"}
    assert len(scored.collect()) == len(odd) == len(scored.collect())
