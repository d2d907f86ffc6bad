import hashlib
import re

from pyspark.sql import functions as F

from shelfseries.llm import exact


def brute(pairs):
    norm = [re.sub(rb"[\x20\x09-\x0d]+", b" ", (t or "").encode()) for _, t in pairs]
    out = []
    for (i, _), body in zip(pairs, norm):
        ids = [j for (j, _), other in zip(pairs, norm) if other == body]
        keep = min((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(body).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_classes(make, odd):
    assert rows(exact.classes(make(odd))) == brute(odd)


def test_bytes_decide_when_hashes_collide(make, odd):
    same = exact.classes(make(odd), content_hash=lambda c: F.lit("h"), fingerprint=lambda c: F.lit("f"))
    assert [r[:4] for r in rows(same.drop("text_sha256"))] == sorted((r[:4] for r in brute(odd)), key=str)
    half = exact.classes(make(odd), content_hash=lambda c: F.lit("h"))
    assert rows(half) == brute(odd)


def test_deduplicate_keeps_all_columns(make, odd):
    docs = make(odd)
    left = exact.deduplicate(docs)
    assert left.columns == docs.columns and left.schema == docs.schema
    want = {r[0] for r in brute(odd) if r[3] and r[0] is not None}
    got = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in got if i is not None) == sorted(want)
    assert got.count(None) == 2


def test_empty(make):
    assert exact.classes(make([])).count() == 0 and exact.deduplicate(make([])).count() == 0
