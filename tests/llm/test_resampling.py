import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfseries.llm import resampling
from shelfseries.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    runs = [" ".join(words[a:a + n]) for n in (1, 2, 3) for a in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def brute(docs, target):
    """``[(id, text)] -> [(id, features, weight, score, rank)]``."""
    found = [(i, *buckets(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, b in found:
        s.update(b)
    for x in target:
        t.update(buckets(x)[1])
    of, to = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * of / ((s[b] + 1) * to))) for b in range(10000)]
    rows = []
    for i, words, b in found:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] * n for k, n in b.items())
        rows.append([i, sum(b.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, words])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def rows_of(df):
    return sorted(map(tuple, df.select("id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_buckets_of_odd_texts(odd):
    texts = [(t or "").encode() for _, t in odd] + [b"a" * 62 + b" " + b"b" * 63 + b" " + b"c" * 64 + b" " + b"d" * 65 + b" e " + b"f" * 5000]
    got = list(resampling.Features().of(texts))
    for text, (words, n, parts) in zip(texts, got):
        want_words, want = buckets(text.decode())
        assert words == want_words and n == sum(want.values())
        assert Counter(np.concatenate(parts).tolist() if parts else []) == want


def test_words_are_forgotten_at_a_bound(monkeypatch):
    monkeypatch.setattr(resampling, "_KNOWN", 3)
    monkeypatch.setattr(resampling, "_GROUP", 10)
    texts = ["one two three four five", "", "one two", "x y z one"] * 3
    for text, (_, _, parts) in zip(texts, resampling.Features().of(t.encode() for t in texts)):
        assert Counter(np.concatenate(parts).tolist() if parts else []) == buckets(text)[1]


@pytest.mark.parametrize("rows, digit", [(1 << 20, 12), (50, 3)])
def test_radix_ranks(spark, monkeypatch, rows, digit):
    monkeypatch.setattr(resampling, "ROWS", rows)
    monkeypatch.setattr(resampling, "DIGIT", digit)
    r = random.Random(2)
    pairs = [(r.choice([5, 5, 5, -3, 12]) if digit == 3 else r.choice([0, 7, -2, 1 << 40]), r.randrange(60) if digit == 3 else r.randrange(-(1 << 63), 1 << 63)) for _ in range(700)] + [(5, 5)] * 30
    df = spark.createDataFrame(pairs, "a long, b long").repartition(5)
    got = sorted((x["position"], x["a"], x["b"]) for x in resampling.radix_ranks(df, [F.col("a"), F.col("b")]).collect())
    assert [p for p, _, _ in got] == list(range(len(pairs))) and [(a, b) for _, a, b in got] == sorted(pairs)
    same = spark.createDataFrame([(1,)] * 9, "a long")
    assert sorted(x["position"] for x in resampling.radix_ranks(same, [F.col("a")]).collect()) == list(range(9))


def test_odd_documents_against_brute_force(spark, make, odd):
    rows = odd + [(1000 + k, f"tail {k} " * 12) for k in range(60)] + [(None, "no id " * 20), (None, "no id " * 20)]
    target = ["tail 7 tail 7", None, "", "two words"]
    table = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(make(rows).withColumns({"rank": F.lit(1), "weight": F.lit("w")}), table)
    want = brute(rows, target)
    assert rows_of(got) == want and sum(r[4] is not None for r in want) >= 3
    # an id that occurs twice brings both rows
    ids = Counter(i for i, _ in rows)
    drawn = resampling.drawn(make(rows), got)
    assert drawn.columns == make(rows).columns
    assert drawn.count() == sum(ids[i] for i in {r[0] for r in want if r[4] and r[0] is not None})


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resample(docs, docs.select("text")).collect() == []
    few = [(i, "word " * (i + 10)) for i in range(30)]
    got = resampling.resample(spark.createDataFrame(few, "doc_id long, text string"), docs.select("text"))
    assert rows_of(got) == brute(few, [])


def test_query_against_brute_force(spark, small):
    (name,) = [q for q in QUERIES if q.startswith("op13_")]
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert rows_of(QUERIES[name](spark, small).withColumnRenamed("doc_id", "id")) == brute(docs, target)
