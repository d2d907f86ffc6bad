import random

import numpy as np
import pyarrow as pa
import pytest

from shelfseries.llm import neardup
from shelfseries.llm.components import components
from tests.llm import brute


def found(df):
    return {r["id"]: (r["n_shingles"], r["component"]) for r in df.collect() if r["id"] is not None}


def unique(pairs):
    return [(i, t) for k, (i, t) in enumerate(pairs) if i is not None and i not in {j for j, _ in pairs[:k]}]


@pytest.mark.parametrize("k", [4, 5])
def test_odd_documents(make, odd, k):
    pairs = unique(odd)
    assert found(neardup.near_duplicates(make(pairs), shingle=k)) == brute.components(pairs, k)


def test_repeats_and_missing_ids(make, odd):
    rows = neardup.near_duplicates(make(odd)).collect()
    assert len(rows) == len(odd)
    assert all(r["component"] is None for r in rows if r["id"] is None)
    assert {r["component"] for r in rows if r["id"] == 22} == {22}


def test_family_of_near_copies(make, monkeypatch):
    """Copies with several edits each: some are linked to the original, some only to others, some to none."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    r = random.Random(2)
    names = ["w%d" % k for k in range(3000)]
    base = r.choices(names, k=120)
    pairs = []
    for i in range(150):
        ws = list(base)
        for _ in range(r.randint(0, 9)):
            ws[r.randrange(len(ws))] = r.choice(names)
        pairs.append((500 - i, " ".join(ws)))
    pairs += [(1000 + i, " ".join(r.choices(names, k=80))) for i in range(30)]
    want = brute.components(pairs)
    assert len({c for _, c in want.values()}) > 32
    assert found(neardup.near_duplicates(make(pairs), shingle=4)) == want


def test_pairs_below_the_match_threshold_are_not_retained(make):
    """Collisions decide: no pair can share more coordinates than there are, so an unreachable threshold keeps none."""
    base = " ".join("w%d" % k for k in range(100))
    pairs = [(1, base), (2, base + " end")]
    assert found(neardup.near_duplicates(make(pairs), shingle=4))[2][1] == 1
    seeds = np.arange(1, 129, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    one, two = (neardup._signature(neardup.shingles(t.encode(), 4), seeds[:64] | np.uint64(1), seeds[64:]) for _, t in pairs)
    assert 32 <= neardup.collisions(one, two[None])[0] < 65
    rows = {"rep": [1, 2], "sig": [one.tobytes(), two.tobytes()], "sketch": [neardup.sketch(neardup.shingles(t.encode(), 4)).tobytes() for _, t in pairs]}
    batch = pa.RecordBatch.from_pydict({"a": [1], "b": [2], "n_a": [97], "n_b": [98],
                                        **{f"{c}_{n}": [rows[c][k]] for c in ("sig", "sketch") for k, n in enumerate("ab")}})
    for matches, kept in ((32, 1), (65, 0)):
        assert next(neardup._agree(80, matches)([batch])).num_rows == kept


def test_a_long_list_stays_near_linear(spark):
    """100,000 members, of which 300 stand outside the largest component, and a short list."""
    lists = spark.range(100_000).selectExpr("7L as key", "id as rep").unionByName(
        spark.createDataFrame([(8, 100_001), (8, 100_002), (9, 100_005), (9, 100_006)], "key long, rep long"))
    comps = spark.range(300, 100_000).selectExpr("id as u", "999999L as component").unionByName(
        spark.createDataFrame([(100_006, 100_005)], "u long, component long"))
    dealt = neardup._dealt(neardup._still_open(lists, comps)).cache()
    blocks = -(-100_000 // neardup.BLOCK)
    assert dealt.where("key = 7").count() <= 100_000 + 300 * blocks
    assert dealt.groupBy("key", "block", "chunk").count().agg({"count": "max"}).first()[0] < 2 * neardup.BLOCK
    met = dealt.where("asks").select("key", "block", "chunk", "rep").join(
        dealt.where("home").select("key", "block", "chunk", dealt["rep"].alias("other")), ["key", "block", "chunk"])
    assert met.where("key = 7").select("rep", "other").distinct().count() == 300 * 100_000
    assert {tuple(r) for r in dealt.where("key = 8").select("block", "chunk", "rep").collect()} == {(0, 0, 100_001), (0, 0, 100_002)}
    assert dealt.where("key = 9").count() == 0


def test_deduplicate(make, odd):
    pairs = unique(odd)
    left = neardup.deduplicate(make(pairs), shingle=4)
    assert left.columns == make([]).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(i for i, (_, c) in brute.components(pairs).items() if i == c)


def test_empty(make):
    assert neardup.near_duplicates(make([])).count() == 0
    assert neardup.near_duplicates(make([(1, None), (2, "")])).count() == 2


def test_sketch_estimates_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 1 << 63, 3000, dtype=np.uint64) * np.uint64(2))
    b = np.unique(np.concatenate([a[300:], r.integers(0, 1 << 63, 300, dtype=np.uint64) * np.uint64(2)]))
    share, near = neardup.alike(neardup.sketch(a), neardup.sketch(b)[None], len(a), np.array([len(b)]), 80)
    assert abs(share[0] - 2700 / 3300) < 0.1 and near[0]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 200), (200, 150), (7, 7)], "u long, v long")
    got = {r["u"]: r["component"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, 150: 100, 200: 100}
