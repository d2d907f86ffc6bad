import numpy as np
from pyspark.sql import functions as F

from shelfseries.llm import ann


def brute(ids, x, asks, k):
    out = {}
    for q in [i for i, a in enumerate(asks) if a]:
        s = (x * x[q]).sum(axis=1)
        other = [j for j in range(len(ids)) if j != q]
        out[ids[q]] = [(ids[j], s[j]) for j in sorted(other, key=lambda j: (-s[j], ids[j]))[:k]]
    return out


def got(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_recall_on_the_table(spark, medium):
    table = spark.read.parquet(f"{medium}/embeddings.parquet")
    asks = F.col("vec_id") % 20 == 0
    exact, found = got(ann.search(table, asks, method="all")), got(ann.search(table, asks))
    rows = table.orderBy("vec_id").collect()
    ids, x = [r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64)
    want = brute(ids, x, [i % 20 == 0 for i in ids], 20)
    assert {q: [v for v, _ in r] for q, r in exact.items()} == {q: [v for v, _ in r] for q, r in want.items()}
    hits = [len({v for v, _ in found[q]} & {v for v, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9 and all(len(r) == 20 for r in found.values())


def test_odd_vectors(spark):
    r = np.random.default_rng(4)
    rows = [(i, [float(v) for v in r.standard_normal(16)], "x", 1) for i in range(60)]
    same = rows[3][1]
    rows += [(100 + i, same, "x", 1) for i in range(40)] + [(100, same, "x", 1)]
    bad = [(200, None), (201, []), (202, [0.0] * 16), (203, [float("nan")] + [1.0] * 15), (204, [float("inf")] + [1.0] * 15), (205, [None] + [1.0] * 15), (206, [1.0] * 3), (None, [1.0] * 16)]
    table = spark.createDataFrame(rows + [(i, v, "x", 1) for i, v in bad], "vec_id long, embedding array<double>, rep string, rank int")
    good = rows[:-1]
    want = brute([i for i, *_ in good], np.array([v for _, v, *_ in good]), [i % 5 == 0 for i, *_ in good], 20)
    for method in ("all", "index"):
        found = got(ann.search(table, F.col("vec_id") % 5 == 0, 20, method=method))
        assert sorted(found) == sorted(want)
        for q in want:
            assert all(abs(s - dict(want[q]).get(v, s)) < 1e-12 for v, s in found[q]) and len(found[q]) == 20
    # of a hundred equal vectors every one finds its twins, smallest ids first
    assert [v for v, _ in found[135]] == [v for v, _ in want[135]]


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [2.0, 0.0])], schema)
    assert got(ann.search(few, F.col("vec_id") == 0)) == {0: [(2, 2.0), (1, 0.5)]}
    assert ann.search(few.limit(0), F.lit(True)).count() == 0
    assert ann.search(spark.createDataFrame([(0, [0.0, 0.0])], schema), F.lit(True)).count() == 0


def test_probing_retrieves_every_code_within_the_radius():
    r = np.random.default_rng(2)
    code = r.integers(0, 256, (3000, 4), dtype=np.uint8)
    index = ann.Index(code)
    for radius in (0, 3, 6, 9, 32, 64):
        q = code[5] ^ np.uint8(1)
        apart = np.bitwise_count(code ^ q).sum(axis=1)
        assert index.within(q, radius).tolist() == np.flatnonzero(apart <= radius).tolist()
