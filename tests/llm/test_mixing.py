import math
import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from shelfseries.llm import mixing


def rounds(sizes, weights=(1, 2, 3), most=3):
    """Targets of ``[size]`` by sharing the excess out again and again."""
    share = [Fraction(weights[k % len(weights)]) for k in range(len(sizes))]
    out = [Fraction(0)] * len(sizes)
    left, open_ = Fraction(sum(sizes)), list(range(len(sizes)))
    while left and open_:
        of = sum(share[k] for k in open_)
        give = {k: left * share[k] / of for k in open_}
        left = Fraction(0)
        for k, x in give.items():
            out[k] += x
            if out[k] > most * sizes[k]:
                left += out[k] - most * sizes[k]
                out[k] = Fraction(most * sizes[k])
        open_ = [k for k in open_ if out[k] < most * sizes[k]]
    return out


@pytest.mark.parametrize("sizes", [[10, 20, 30], [1, 1, 1000], [5, 0, 7, 900, 1, 2, 3000], [0, 0], [7], [1000, 1, 2, 1, 1, 1, 50], [3] * 11])
def test_targets_against_repeated_sharing(spark, sizes):
    names = [None if k == len(sizes) - 1 else f"s{k:02d}" for k in range(len(sizes))]
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long").repartition(3)
    got = {r["source"]: r for r in mixing.targets(table).collect()}
    for name, size, want in zip(names, sizes, rounds(sizes)):
        r = got[name]
        assert r["target"] == pytest.approx(float(want)) and r["budget"] == math.floor(want)
        assert r["epochs"] * size + r["rest"] == r["budget"] and (r["rest"] < max(size, 1))


def by_hand(mixed):
    """What every source's sample must take, from the rows of a mix with their keys."""
    groups = defaultdict(list)
    for r in mixed:
        groups[r["source"]].append(r)
    for name, rows in groups.items():
        size = sum(r["size"] for r in rows)
        assert {r["source_size"] for r in rows} == {size}
        budget = math.floor(Fraction(rows[0]["target"]).limit_denominator(10**6) + Fraction(1, 10**7))
        assert sum(r["taken"] for r in rows) == budget
        rest = budget - (budget // size if size else 0) * size
        for r in sorted(rows, key=lambda r: (r["carried"]["k"], r["id"] is not None, r["id"] or 0, r["size"])):
            extra = min(max(rest, 0), r["size"])
            assert r["taken"] == r["epochs"] * r["size"] + extra and r["taken"] <= 3 * r["size"]
            rest -= r["size"]


def test_mix_by_hand(spark, make, odd):
    docs = make(odd).withColumn("source", F.when(F.col("doc_id") % 5 == 0, None).when(F.col("doc_id") % 7 == 0, "").otherwise(F.col("source")))
    docs = docs.withColumn("k", mixing.exponential_key("mix", F.col("doc_id"), F.col("key") + F.col("body")))
    mixed = mixing.mix(docs, F.col("key") + F.col("body"), carry=("k", "text")).collect()
    assert len(mixed) == len(odd)
    count = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, t in odd}
    assert {(r["id"], r["size"]) for r in mixed} == count
    by_hand(mixed)
    again = mixing.mix(docs.repartition(5), F.col("key") + F.col("body"), carry=("k", "text")).collect()
    key = lambda r: (str(r["id"]), r["size"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, mixed))

    texts = mixing.corpus(mixing.mix(docs, F.col("key") + F.col("body"), carry=("text",))).collect()
    assert sum(r["words"] for r in texts) == sum(r["taken"] for r in mixed)
    originals = {t for _, t in odd if t}
    for r in texts:
        assert len(r["text"].split()) >= 1 and len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) == r["words"]
        assert r["text"] in originals or any(t.startswith(r["text"]) for t in originals)


def test_quality_orders_the_sample(spark):
    rows = [(i, "w " * 10, "a" if i < 1000 else "b") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, F.when(F.col("doc_id") % 2 == 0, 9.0).otherwise(1.0)).where("source = 'a'").collect()
    even = sum(r["taken"] for r in mixed if r["id"] % 2 == 0)
    odd = sum(r["taken"] for r in mixed if r["id"] % 2)
    assert even + odd == 6666 and even > 0.68 * (even + odd)  # about 0.72 are expected, half without weights


def test_hot_source_and_empty_table(spark):
    rows = [(i, "one two three", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)
    mixed = mixing.mix(docs).collect()
    for source in {r["source"] for r in mixed}:
        mine = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 1
        assert sum(0 < r["taken"] % 3 for r in mine) <= 1  # one document is cut at most
    assert mixing.mix(docs.limit(0)).collect() == []
    none = spark.createDataFrame([(1, None, None), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["size"], r["target"], r["taken"]) for r in mixing.mix(none).collect()] == [(0, 0.0, 0)] * 2


def test_ratings_hold_where_they_are_given(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i < 100 else "b") for i in range(200)], "doc_id long, text string, source string")
    ratings = spark.createDataFrame([(i, float(q)) for i in range(0, 100, 2) for q in (0, 1e6)] + [(1, None), (None, 5.0)], "id long, quality double")
    mixed = mixing.mix(docs, ratings=ratings).where("source = 'a'").collect()
    assert all(r["taken"] == 10 for r in mixed if r["id"] % 2 == 0) and sum(r["taken"] for r in mixed) == 666
    assert next(r["taken"] for r in mixed if r["id"] == 1) == 0
