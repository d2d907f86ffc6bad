import hashlib

import numpy as np
import pytest

from shelfseries.llm import substring
from shelfseries.llm.staging import hold
from shelfseries.llm.words import hashes_and_text, window_hashes, word_hashes
from tests.llm import brute


def got(df):
    return {r["id"]: (r["n_words"], r["n_removed"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect() if r["id"] is not None}


@pytest.mark.parametrize("cells", [None, 1 << 16])
def test_odd_documents(make, odd, cells):
    pairs = [(i, t) for i, t in odd if i is not None]
    pairs = [(i, t) for i, t in pairs if (i, t) != (21, None)]
    assert got(substring.cut_repeats(make(pairs), cells=cells)) == brute.cut_repeats(pairs)


def test_full_sketch_loses_nothing(make, odd, monkeypatch):
    """A sketch that suspects every window only costs time."""
    cells = 1 << 16
    monkeypatch.setattr(substring, "repeated_cells", lambda *_: np.full(substring.ROWS * cells // 8, 255, np.uint8))
    pairs = [(i, t) for i, t in odd if i is not None and i < 15]
    assert got(substring.cut_repeats(make(pairs), cells=cells)) == brute.cut_repeats(pairs)


def test_a_sketch_beyond_the_broadcast_is_joined(make, odd, monkeypatch):
    """The same result, and documents without a repeated window are suspected no more than with a broadcast."""
    held = {}

    def keep(df, name):
        held[name] = hold(df, name)
        return held[name]

    monkeypatch.setattr(substring, "hold", keep)
    pairs = [(i, t) for i, t in odd if i is not None]
    pairs = [(i, t) for i, t in pairs if (i, t) != (21, None)]
    docs = make(pairs + [(None, pairs[0][1])])
    listed = []
    for most in (0, substring.BROADCAST_CELLS):
        rows = substring.cut_repeats(docs, carry=("source",), most_broadcast=most)
        assert rows.columns == ["id", "carried", "n_words", "n_removed", "kept"]
        assert got(rows) == brute.cut_repeats(pairs)
        assert sum(r["id"] is None for r in rows.collect()) == 1
        listed.append(sorted(r["id"] for r in held["substring-suspects"].select("id").collect()))
    assert listed[0] == listed[1]
    assert not {9, 10, 12, 15, 18, 19, 20, 21} & set(listed[0])
    assert {"substring-cells", "substring-marks"} <= set(held)
    assert substring.cut_repeats(make([]), most_broadcast=0).count() == 0


def test_the_sketch_grows_with_the_text(spark):
    """A cell for every eight bytes of text, also beyond the bound of a broadcast."""
    def docs(megabytes):
        return spark.range(megabytes).selectExpr("id", f"repeat('x', {1 << 20}) as body")

    assert [substring.cells_for(docs(m)) for m in (1, 64, 512)] == [substring.LEAST_CELLS, 1 << 23, 1 << 26]


def test_no_id_and_carried_columns(make, odd):
    docs = make(odd)
    rows = substring.cut_repeats(docs, carry=tuple(docs.columns)).collect()
    assert len(rows) == len(odd)
    assert all(r["n_removed"] == 0 for r in rows if r["id"] is None)
    assert sorted(map(str, (r["carried"]["text"] for r in rows))) == sorted(str(t) for _, t in odd)


def test_empty(make):
    assert substring.cut_repeats(make([])).count() == 0


def test_other_widths(make):
    pairs = [(3, "a b c d e f"), (1, "x b c d y"), (2, "c d e f g")]
    assert got(substring.cut_repeats(make(pairs), width=3)) == brute.cut_repeats(pairs, 3)


def test_window_hash_depends_on_words_alone():
    a, b = word_hashes(b"q w e r t y u i o p"), word_hashes(b"zz q w e r t y")
    assert np.array_equal(window_hashes(a, 4)[:3], window_hashes(b, 4)[1:])
    assert len(window_hashes(a, 11)) == 0


def test_texts_are_sorted_out_once(make, odd, monkeypatch):
    """One pass decides on every text and keeps what it read: the result neither asks the sketch again nor normalises text."""
    held = {}

    def keep(df, name):
        held[name] = hold(df, name)
        return held[name]

    monkeypatch.setattr(substring, "hold", keep)
    pairs = [(i, t) for i, t in odd if i is not None]
    pairs = [(i, t) for i, t in pairs if (i, t) != (21, None)]
    rows = substring.cut_repeats(make(pairs), carry=("source",))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "regexp_replace" not in plan  # the words of the suspects are cut
    assert got(rows) == brute.cut_repeats(pairs)
    texts = {r["id"]: r for r in held["substring-texts"].collect()}
    assert set(texts) == {i for i, _ in pairs}
    suspects = {r["id"] for r in held["substring-suspects"].collect()}
    assert {i for i, r in texts.items() if r["kept"] is None} == suspects == {i for i, r in texts.items() if r["body"] is not None}
    substring.cut_repeats(make(pairs), changed_only=True)
    assert {r["id"] for r in held["substring-texts"].collect()} == suspects


def test_suspicion_of_neighbouring_windows():
    """Windows that share a minimiser share what is known of it."""
    h = word_hashes(" ".join(str(k % 90) for k in range(400)).encode())
    m = substring.minimisers(h, 50)
    for some in (m[:0], m[::7], m):
        assert np.array_equal(substring.suspected(h, 50, lambda few: np.isin(few, some)), np.isin(m, some))


@pytest.mark.parametrize("raw", [b"", b" \n", b"one", b" two  words\x0b", b"ab " * 3_000_000])
def test_hashes_and_text(raw):
    h, text = hashes_and_text(raw)
    assert np.array_equal(h, word_hashes(raw)) and h.dtype == np.uint64
    assert text == b" ".join(raw.split())
