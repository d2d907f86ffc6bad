import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfseries.llm import audit

WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    upper = {c: c + 32 for c in range(65, 91)}
    return [w.translate(upper) for w in WORD.findall(text)]


def brute(rows, most=200):
    """``[(text, lang, source)] -> {(lang, source, part, item, value, rank)}``."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, n, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        ws = terms(text)
        docs[lang].update(set(ws))
        n[lang, source].update(ws)
        total[lang].update(ws)
    out = set()
    f = lambda p, q: (p - q) * (p - q) // q
    for lang in docs.keys() | {r[1] for r in rows}:
        kept = sorted(t for t, k in docs[lang].items() if k >= 3)
        groups = sorted({r[2] for r in rows if r[1] == lang}, key=lambda s: s.encode())

        def shares(c):
            whole = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // whole for t in kept}

        p, q = {s: shares(n[lang, s]) for s in groups}, shares(total[lang])
        for s in groups:
            found = {"pair": [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s],
                     "term": [(f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]}
            for part, items in found.items():
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(items) if part == "pair" or k < most}
    return out


def rows_of(df):
    rows = [tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def texts():
    r = random.Random(3)
    long = "x" * 70 + "y" * 30
    words = ["a", "The", "the", "Straße", "straße", "中文", "don't", "abcdefgh", "abcdefghi", "abcdefg", long, long + "z", long + "zz", "_-_", "9x9", "É é", "\U0001f642"]
    words += ["".join(r.choices("abcd", k=r.randint(1, 20))) for _ in range(60)]
    rows = [(" ".join(r.choices(words, k=r.choice([0, 1, 5, 200]))), r.choice(["en", "de", None, "", "tail"]), r.choice(["s1", "s2", "S", None, "", "é"])) for _ in range(150)]
    return rows + [(None, "en", "silent"), ("", "fr", "alone"), (None, None, None), ("one two", "xx", "s1"), ("one two", "xx", "s1"), ("one two three", "xx", "s2")] + [("rare" * 100_000, "en", "s1")] * 3


def test_pointers_and_runs(texts):
    raw = [(t or "").encode() for t, _, _ in texts]
    begin = np.cumsum([0] + [len(x) for x in raw])[:-1]
    text, start, size = audit.word_pointers(np.frombuffer(b"".join(raw), np.uint8), begin)
    words = [text[s:s + k].tobytes().decode() for s, k in zip(start, size)]
    assert words == [w for t, _, _ in texts for w in terms(t or "")]
    at, head = audit.sort_pointers(text, start, size)
    order = sorted(range(len(words)), key=lambda k: (words[k].encode(), k))
    assert at.tolist() == order
    assert head.tolist() == [k == 0 or words[order[k]] != words[order[k - 1]] for k in range(len(order))]


@pytest.mark.parametrize("block, piece", [(512, 8 << 20), (2, 300)])
def test_against_brute_force(spark, texts, monkeypatch, block, piece):
    monkeypatch.setattr(audit, "BLOCK", block)
    monkeypatch.setattr(audit, "SLICE", piece)
    docs = spark.createDataFrame([(*r, "t", 1, "e") for r in texts], "text string, lang string, source string, term string, n int, entries string").repartition(5)
    if piece == 300:  # workers do not see the patched bounds: run the kernel here
        batches = [b for b in docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")]).toArrow().to_batches()]
        counts = Counter()
        for b in audit._count_terms(batches):
            for r in b.to_pylist():
                counts[r["lang"], r["source"], r["term"]] += r["n"]
        want = Counter((l or "", s or "", w) for t, l, s in texts for w in terms(t or ""))
        assert counts == want
    assert rows_of(audit.divergence(docs, 20)) == brute(texts, 20)


def test_blocks_of_sources(spark):
    r = random.Random(1)
    words = ["".join(r.choices("abc", k=3)) for _ in range(25)]
    rows = [(" ".join(r.choices(words, k=6)), r.choice(["x", "y"]), f"s{r.randrange(600):03d}") for _ in range(1500)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = audit.pairs(audit.count(docs)).where("lang = 'x' and source < 's010'")
    want = {x[:2] + x[3:5] for x in brute(rows) if x[0] == "x" and x[1] < "s010" and x[2] == "pair"}
    assert {tuple(x) for x in got.select("lang", "source", "item", "value").collect()} == want


def test_large_counts_are_exact(spark):
    n, words, kept = 9 * 10**17, 3 * 10**18, 10**9
    p = spark.range(1).select(audit.share(F.lit(n), F.lit(words), F.lit(kept)).alias("p")).first()["p"]
    assert p == 1 + 10**9 * (n + 1) // (words + kept)
    whole = np.array([9 * 10**15 - 7, 11, 1])
    some = np.array([7 * 10**15, 10, 0])
    assert audit._shares(some, whole).tolist() == [1 + 10**9 * (int(a) + 1) // int(b) for a, b in zip(some, whole)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "text string, lang string, source string")
    assert audit.divergence(docs).collect() == []
    silent = spark.createDataFrame([(None, "en", "a"), ("", "en", "b"), ("- 1", None, None)], "text string, lang string, source string")
    assert rows_of(audit.divergence(silent)) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
