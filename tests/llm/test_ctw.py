import math
import random
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfseries.llm import ctw, words


def naive(codes, depth):
    """log10-probability of a code's byte by the recursive definition, with dictionaries."""
    counts = Counter()
    for c in codes:
        byte = c & 255
        for d in range(depth + 1):
            context = (c >> 8) & ((1 << 8 * d) - 1)
            for level in range(8):
                counts[d, context, level, byte >> (8 - level), (byte >> (7 - level)) & 1] += 1
    nodes = {k[:4] for k in counts}

    def pair(node):
        return counts[*node, 0], counts[*node, 1]

    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted = {}
    for node in sorted(nodes, reverse=True):
        d, context, level, prefix = node
        own = kt(*pair(node))
        if d < depth:
            children = sum(weighted[n] for n in nodes if n[0] == d + 1 and n[1] & ((1 << 8 * d) - 1) == context and n[2:] == (level, prefix))
            weighted[node] = math.log(.5) + max(own, children) + math.log1p(math.exp(-abs(own - children)))
        else:
            weighted[node] = own

    def log10(c):
        byte, total = c & 255, 0.0
        for level in range(8):
            bit, p, begun = (byte >> (7 - level)) & 1, .5, False
            for d in range(depth, -1, -1):
                node = (d, (c >> 8) & ((1 << 8 * d) - 1), level, byte >> (8 - level))
                if node not in nodes:
                    continue
                a, b = pair(node)
                own = (b + .5) / (a + b + 1)
                own = own if bit else 1 - own
                share = math.exp(kt(a, b) + math.log(.5) - weighted[node]) if begun and d < depth else 1.0
                p, begun = share * own + (1 - share) * p, True
            total += math.log10(p)
        return total
    return log10


def test_tree_against_the_definition():
    r = random.Random(1)
    data = bytes(r.choices(b"abcd ", weights=[5, 3, 2, 1, 3], k=400)) + b"\n"
    codes = ctw.codes_after(b"\n\n", data)
    tree = ctw.Tree(codes, np.ones(len(codes)), 2)
    log10 = naive([int(c) for c in codes], 2)
    for text in (b"abba d", b"zz\xffa", b"dcba\n"):
        asked = ctw.codes_after(b"\n\n", text)
        assert np.allclose(tree.log10(asked), [log10(int(c)) for c in asked], atol=1e-6)


def test_probabilities_sum_to_one():
    codes = ctw.codes_after(b"\n\n\n", b"the cat sat on the mat\n" * 5)
    tree = ctw.Tree(codes, np.ones(len(codes)), 3)
    for context in (b"the", b" ca", b"xyz", b"\n\n\n"):
        every = np.concatenate([ctw.codes_after(context, bytes([b])) for b in range(256)])
        assert abs((10 ** tree.log10(every)).sum() - 1) < 1e-5


def test_long_texts_are_coded_in_stretches(monkeypatch):
    monkeypatch.setattr(ctw, "_CHUNK", 50)
    texts = [b"A b" * 3, b"", b"word " * 40, b"x y z", b"q" * 70]
    got = {k: [] for k in range(len(texts))}
    for numbers, codes, begin, size in ctw.coded(texts, 3):
        for k, at, n in zip(numbers, begin, size):
            got[k].extend(codes[at:at + n].tolist())
    for k, t in enumerate(texts):
        assert got[k] == ctw.codes_after(b"\n" * 3, ctw.stream(t)).tolist()


def brute_base(pairs, held):
    cnt = Counter()
    tokens = [[w for w in (t or "").encode().lower().split()] + [b"\n"] for _, t in pairs]
    for (i, _), ws in zip(pairs, tokens):
        if not held(i):
            cnt.update(ws)
    n, v = sum(cnt.values()), len(cnt)
    return sorted((i, held(i), len(ws), sum(cnt[w] > 0 for w in ws), n, round(sum(math.log10((cnt[w] + .5) / (n + .5 * (v + 1))) for w in ws), 4)) for (i, _), ws in zip(pairs, tokens))


def test_odd_documents(make, odd):
    pairs = [(-1 if i is None else i, t) for i, t in odd]
    for head, most in product((1 << 17, 20), (700_000,)):
        rows = ctw.score(make(pairs), F.col("doc_id") % 3 == 0, head=head, most_pairs=most).collect()
        got = sorted((r["id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in rows)
        assert got == brute_base(pairs, lambda i: i % 3 == 0)
        assert all(r["score"] < 0 for r in rows)


def test_pruned_trees_stay_close(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet").where("n_chars < 4000")
    total = []
    for most in (700_000, 60_000):
        rows = ctw.score(docs, F.col("doc_id") % 5 == 1, depth=4, most_pairs=most).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
        total.append(rows[0])
    assert total[0] > total[1] > 1.2 * total[0]


def test_learns_more_than_word_counts(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    r = ctw.score(docs, F.col("doc_id") % 5 == 1).agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > r[1]


def test_empty_and_untrained(make):
    assert ctw.score(make([]), F.lit(False)).count() == 0
    (r,) = ctw.score(make([(1, "ab")]), F.lit(True)).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (2, 0, 0) and abs(r["score"] + 24 * math.log10(2)) < 1e-9


def test_no_pair_is_dropped(make):
    """More (context, byte) pairs than any bound that the model used to have, most of them seen once."""
    r = random.Random(3)
    docs = [(i, " ".join("".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(1, 40))) for _ in range(1500))) for i in range(40)]
    docs += [(i + 100, docs[i][1][:200] + " unseen words \xff") for i in range(3)]
    rows = ctw.score(make(docs), F.col("doc_id") >= 100, head=50, head_codes=1000).collect()
    train = np.concatenate([ctw.codes_after(b"\n" * 6, ctw.stream(t.encode())) for i, t in docs if i < 100])
    pairs, n = np.unique(train, return_counts=True)
    assert len(pairs) > 1_000_000
    tree = ctw.Tree(pairs, n.astype(float))
    text = dict(docs)
    for row in rows:
        assert math.isclose(row["score"], tree.log10(ctw.codes_after(b"\n" * 6, ctw.stream(text[row["id"]].encode()))).sum(), rel_tol=1e-5)


def test_values_do_not_depend_on_the_tables_in_memory(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    some, none = ({r["id"]: r["score"] for r in ctw.score(docs, F.col("doc_id") % 5 == 1, depth=depth, head_codes=k).collect()} for depth, k in ((4, 1 << 21), (4, 0)))
    assert some.keys() == none.keys() and all(math.isclose(some[i], none[i], rel_tol=1e-9) for i in some)


def _odd_bytes():
    r = random.Random(4)
    some = [0, 9, 10, 11, 12, 13, 28, 31, 32, 32, 65, 90, 97, 133, 160, 194, 255]
    return [bytes(r.choices(some, k=r.randint(0, 40))) for _ in range(400)] + [b"", b" ", b"a", b"A\x00b ", b"Ab aB " * 300]


@pytest.mark.parametrize("size", [1 << 22, 100, 1])
def test_lower_words_are_those_of_split(monkeypatch, size):
    """Also for bytes that are no UTF-8, and where a text is looked at in pieces."""
    monkeypatch.setattr(words, "_SLICE", size)
    texts = _odd_bytes()
    got = [[] for _ in texts]
    for text, few, at in words.lower_words(pa.array(texts, pa.binary())):
        few = few.to_pylist()
        assert len(few) == len(set(few)) and b"" not in few
        for k, w in zip(text.tolist(), at.tolist()):
            got[k].append(few[w])
    assert got == [x.lower().split() for x in texts]


@pytest.mark.parametrize("flush", [400_000, 10])
def test_count_words(monkeypatch, flush):
    """Words of training texts are counted, those of other texts listed too."""
    monkeypatch.setattr(ctw, "_FLUSH", flush)
    monkeypatch.setattr(words, "_SLICE", 200)
    texts = _odd_bytes()
    train = [k % 3 > 0 for k in range(len(texts))]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[at:at + 90], pa.binary()), pa.array(train[at:at + 90])], names=["body", "train"]) for at in range(0, len(texts), 90)]
    want, got = Counter(), Counter()
    for x, learn in zip(texts, train):
        for w in x.lower().split():
            want[w] += learn
    for b in ctw._count_words(batches):
        for w, c in zip(b.column("word").to_pylist(), b.column("c").to_pylist()):
            got[w] += c
    assert dict(got) == dict(want)


@pytest.mark.parametrize("depth", range(8))
def test_codes_after_are_the_bytes_before(depth):
    before, data = bytes(range(1, depth + 1)), b"\xff\x00some text\n"
    for x in (data, b"q", b""):
        want = [int.from_bytes((before + x)[k:k + depth + 1], "big") for k in range(len(x))]
        assert ctw.codes_after(before, x).tolist() == want


def test_codes_inside_texts():
    """Codes of the bytes between two texts are left out."""
    texts = [ctw.stream(x) for x in _odd_bytes()]
    for chunk in (1 << 20, 50, 7):
        got = [[] for _ in texts]
        for own, codes, begin, size in ctw.coded(_odd_bytes(), 3, chunk):
            kept = ctw._inside(codes, begin, size)
            for k, part in zip(own, np.split(kept, np.cumsum(size)[:-1])):
                got[k].extend(part.tolist())
        assert got == [ctw.codes_after(b"\n" * 3, x).tolist() for x in texts]
