import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shelfseries.llm import ctw, staging


@pytest.fixture(scope="module")
def letters():
    """Texts whose codes are nearly all different."""
    r = random.Random(7)
    return [bytes(r.choices(b"abcdefghijklmnopqrstuvwxyz", k=200_000)) for _ in range(20)]


def test_codes_are_counted_in_little_memory(letters):
    train = [k % 4 > 0 for k in range(len(letters))]
    batch = pa.RecordBatch.from_arrays([pa.array(letters, pa.binary()), pa.array(train)], names=["body", "train"])
    got = {"code": [], "n": [], "m": []}
    tracemalloc.start()
    for b in ctw._count_grams(ctw.DEPTH)([batch]):
        assert b.num_rows <= 50_000
        for c, x in got.items():
            x.append(b.column(c).to_numpy().copy())
    held = sum(a.nbytes for x in got.values() for a in x)
    peak = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert peak < 130e6
    every = [ctw.codes_after(ctw.END * ctw.DEPTH, ctw.stream(x)) for x in letters]
    for c, texts in (("m", every), ("n", [x for x, t in zip(every, train) if t])):
        few, counts = np.unique(np.concatenate(texts), return_counts=True)
        codes, at = np.unique(np.concatenate(got["code"]).view(np.uint64), return_inverse=True)
        sums = np.bincount(at, np.concatenate(got[c]))
        assert (codes[sums > 0] == few).all() and (sums[sums > 0] == counts).all()


def _sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["size"])


def test_texts_go_to_python_in_short_batches(spark, monkeypatch):
    monkeypatch.setattr(staging, "BATCH_BYTES", 1 << 20)
    sizes = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("text "), 1000).alias("body")).mapInArrow(_sizes, "size long")
    with staging.text_batches(spark):
        short = staging.hold(sizes, "t")
        with staging.text_batches(spark):  # a bound that is set already stays
            assert spark.conf.get(staging._BATCH) == str(1 << 20)
        assert spark.conf.get(staging._BATCH) == str(1 << 20)
    assert spark.conf.get(staging._BATCH, None) is None
    assert short.agg(F.sum("size")).first()[0] >= 15_000_000
    assert short.agg(F.max("size")).first()[0] < 1_200_000
    with pytest.raises(ValueError), staging.text_batches(spark):
        raise ValueError
    assert spark.conf.get(staging._BATCH, None) is None


def _resident():
    rollup = Path("/proc/self/smaps_rollup").read_text()
    return int(re.search(r"\nPss_Anon:\s+(\d+)", rollup)[1]) / 1024


def _leave_holes(batches):
    """Frees most of many small blocks, but not the last ones, as a task does that remembers words."""
    yield from batches
    blocks = [np.ones(1000) for _ in range(20_000)]
    _kept.append(blocks[-1])


_kept = []


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="no figures of memory")
def test_tasks_give_freed_memory_back():
    before = _resident()
    list(staging.tidy(_leave_holes)([]))
    assert _resident() - before < 50  # of 160


def test_counts_are_listed_before_they_overflow(letters, monkeypatch):
    monkeypatch.setattr(ctw, "_COUNTED", 500)
    monkeypatch.setattr(ctw, "_CHUNK", 200)
    batch = pa.RecordBatch.from_arrays([pa.array([b"a" * 5000], pa.binary()), pa.array([True])], names=["body", "train"])
    found = list(ctw._count_grams(2)([batch]))
    assert len(found) == 9 and sum(sum(b.column("m").to_pylist()) for b in found) == 5001
    assert max(max(b.column("n").to_pylist()) for b in found) <= 700
