import random

import numpy as np

from shelfseries.llm import bpe, tokens


def check(df, pairs):
    t = tokens.tokenizer(tokens.public())
    want = sorted((str(i), tuple(ids := t.encode(x or "", add_special_tokens=False).ids), t.decode(ids, skip_special_tokens=False)) for i, x in pairs)
    encoded = bpe.encode(df)
    plain = sorted((str(r["id"]), tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in encoded.collect())
    decoded = sorted((str(r["id"]), r["text"]) for r in bpe.decode(encoded).collect())
    assert plain == [w[:2] for w in want]
    assert decoded == sorted((w[0], w[2]) for w in want)


def test_odd_documents(make, odd):
    check(make(odd), odd)


def test_small_blocks(make, odd, monkeypatch):
    pairs = odd[:14] + odd[16:]
    pairs = [(i, t) for i, t in pairs if t is None or len(t) < 5000]
    from shelfseries.llm.words import Index

    monkeypatch.setattr(bpe, "BLOCK_BYTES", 500)
    rows = [(k, t or "") for k, (_, t) in enumerate(pairs)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows]), pa.array([t.encode() for _, t in rows])], names=["row", "body"])
    blocks = list(bpe._blocks([batch]))
    assert len(blocks) > 3 and [k for _, docs in blocks for k, _ in docs] == [k for k, _ in rows]
    for words, docs in blocks:
        for k, codes in docs:
            assert [words[c] for c in codes] == rows[k][1].encode().split()
    assert Index().codes(b"") .size == 0


def test_packed_numbers_round_trip():
    for x in (np.arange(1000, dtype=np.uint32), np.array([], np.int64), np.array([-5, 1 << 40], np.int64)):
        assert np.array_equal(bpe._unpack(bpe._pack(x), x.dtype), x)


def test_words_encoded_alone_give_the_text(odd):
    t = tokens.tokenizer(tokens.public())
    coder = tokens.WordEncoder(tokens.public())
    coder.known_words, coder.group_bytes = 50, 1000
    texts = [(x or "").encode() for _, x in odd]
    for text, ids in zip(texts, coder.texts(texts)):
        assert ids.tolist() == t.encode(text.decode(), add_special_tokens=False).ids


def test_empty(make):
    assert bpe.decode(bpe.encode(make([]))).count() == 0


def test_words_by_line_and_alone_have_the_ids_of_the_library():
    r = random.Random(8)
    signs = "abcXYZ'09.,-_<|>\x00\x1f\u00a0\u0301\u0130\u00e9\u4e2d\U0001f642\u2003"
    words = ["".join(r.choices(signs[:13] if k % 3 else signs, k=r.randint(1, 12))) for k in range(5_000)]
    words += ["<|endoftext|>", "a<|startoftext|>b", "\u00a0", "don't", "x" * 300, "x" * 255, "\u0301a"]
    flat, sizes = tokens.encode_words([w.encode() for w in words], tokens.public())
    want = [tokens.tokenizer(tokens.public()).encode(w, add_special_tokens=False).ids for w in words]
    assert sizes.tolist() == list(map(len, want)) and flat.tolist() == [x for ids in want for x in ids]
    assert [len(x) for x in tokens.encode_words([], tokens.public())] == [0, 0]
