import math
import random

import numpy as np
from pyspark.sql import functions as F

from shelfseries.llm import ctw, frequent
from shelfseries.llm.words import Slots, find


def test_slots_find_what_a_search_finds():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 7, 300, 100_000):
        table = np.unique(r.integers(0, 1 << 56, n, dtype=np.uint64) if n != 7 else np.arange(7, dtype=np.uint64))
        keys = np.concatenate([r.permutation(table), r.integers(0, 1 << 56, 1000, dtype=np.uint64), np.zeros(3, np.uint64)])
        at, hit = Slots(table).find(keys)
        expected, known = find(table, keys)
        assert (hit == known).all() and (at[hit] == expected[hit]).all()


def listed(spark, n):
    return spark.createDataFrame([(bytearray(w), c, float(c)) for w, c in n.items()], "word binary, n long, value double")


def test_hashes_agree_and_find_the_numbers(spark):
    words = [b"", b"a", "höß".encode(), bytes(range(1, 9)), b"x" * 31, b"y" * 32, b"z" * 1000, b"seven77"]
    n = {w: 10 ** k for k, w in enumerate(words)}
    found = frequent.frequent(listed(spark, n), "n", "value", head=3, more=6)
    assert found.words == [b"seven77", b"y" * 32, b"x" * 31]
    at, hit = Slots(found.hashes).find(frequent.hashes(words))
    assert [w for w, h in zip(words, hit) if h] == words[2:]
    assert found.more[at[hit]].tolist() == [float(n[w]) for w in words[2:]]


def test_no_hash_is_held_that_two_words_share(spark, monkeypatch):
    """Words of equal length share a hash here, within what is held and with a word that is not."""
    monkeypatch.setattr(frequent, "word_hash", lambda: F.octet_length("word").cast("long"))
    n = {b"aa": 900, b"bb": 800, b"ccc": 700, b"dddd": 600, b"eeeee": 500, b"fff": 1, b"gggggg": 1}
    found = frequent.frequent(listed(spark, n), "n", "value", head=1, more=5)
    assert found.hashes.tolist() == [4, 5] and found.more.tolist() == [600.0, 500.0]


#: Words held as they are, and by hash.
CUTS = [(1 << 17, 1 << 20), (10, 500), (0, 0)]


def documents():
    r = random.Random(7)
    names = ["".join(r.choices("abcdefgh", k=r.randint(1, 9))) for _ in range(3000)]
    return [(i, " ".join(r.choices(names, k=r.randint(0, 90)))) for i in range(400)] + [(900, None), (901, "Ab aB \xff")]


def test_few_words_of_the_texts_are_joined(make, monkeypatch):
    """Of words beyond the head only those that no hash in memory finds become rows."""
    held, hold = {}, ctw.hold
    monkeypatch.setattr(ctw, "hold", lambda df, name: held.update({name: hold(df, name)}) or held[name])
    assert ctw.score(make(documents()), F.col("doc_id") % 5 == 1, head=10).count() == 402
    rare = {bytes(r["word"]) for r in held["ctw-parts"].where("word is not null").collect()}
    assert rare <= {bytes(r["word"]) for r in held["ctw-words"].where("c = 0").collect()}


def test_scores_do_not_depend_on_the_words_in_memory(make):
    docs = make(documents())
    first, *others = ({r["id"]: r for r in ctw.score(docs, F.col("doc_id") % 5 == 1, depth=2, head=head, more=more).collect()} for head, more in CUTS)
    assert len(first) == 402
    for other in others:
        for i, r in first.items():
            assert (r["n_tokens"], r["n_known"]) == (other[i]["n_tokens"], other[i]["n_known"])
            assert all(math.isclose(r[c], other[i][c], rel_tol=1e-9) for c in ("base_score", "score"))
