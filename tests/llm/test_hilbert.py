import zlib
from itertools import product

import numpy as np
import pytest

from shelfseries.llm import hilbert
from shelfseries.llm.staging import new_path


@pytest.mark.parametrize("d,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_visits_neighbours(d, bits):
    points = np.array(list(product(range(1 << bits), repeat=d)))
    at = hilbert.curve_index(points, bits)
    assert sorted(at) == list(range(len(points)))
    assert (np.abs(np.diff(points[np.argsort(at)], axis=0)).sum(axis=1) == 1).all()


def check(rows, pairs, shards):
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in pairs)
    assert sorted((str(r["id"]), r["size"], r["text_crc32"]) for r in rows) == want
    slots = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(shards)}
    assert all(v == list(range(len(v))) for v in slots.values())
    counts = [len(v) for v in slots.values()]
    assert sum(counts) == len(pairs) and max(counts) - min(counts) <= 1
    ordered = sorted(rows, key=lambda r: (r["shard"], r["slot"]))
    assert all(a["curve"] <= b["curve"] for a, b in zip(ordered, ordered[1:]))


@pytest.mark.parametrize("shards", [3, 24, 40])
def test_odd_documents(make, odd, shards):
    check(hilbert.shard(make(odd), shards).collect(), odd, shards)


def test_empty(make):
    assert hilbert.shard(make([]), 5).count() == 0


def test_files_and_pruning(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    placed = hilbert.shard(docs, 24).cache()
    path = new_path(spark, "test-shards")
    hilbert.write(docs, placed, path)
    back = spark.read.parquet(path)
    assert back.drop("shard").exceptAll(docs).count() == 0 and back.count() == docs.count()
    spans = hilbert.manifest(docs, placed, ("lang", "source", "doc_id")).toPandas()
    # a filter on one language, or on one stretch of ids, needs fewer files than there are
    assert ((spans.min_lang <= "de") & (spans.max_lang >= "de")).mean() < 0.8
    assert ((spans.min_doc_id <= 50) & (spans.max_doc_id >= 0)).mean() < 0.9
    placed.unpersist()
