"""BPE encoding and decoding through a table of distinct words.

Documents are taken in blocks of a few megabytes. A block's texts become positions in the list of its distinct words, and
the list is dealt by word, so every occurrence of a word, from all blocks, meets in one partition, where the word is
encoded once. Ids go back to the blocks that asked and are put at the words' positions; decoding joins each id with its
piece. Text itself is never shuffled: blocks send word lists and compressed positions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .words import Index

#: Bytes of text and distinct words after which a block ends.
BLOCK_BYTES, BLOCK_WORDS = 16 << 20, 300_000
#: Positions of one row travel together up to about this many words.
_ROW_WORDS = 400_000
#: Distinct words of a partition that are remembered with their ids.
_KNOWN = 200_000
_ROW = "bucket int, block long, part int, ids binary, sizes binary, body binary"


def _pack(x: np.ndarray) -> bytes:
    """Byte planes of the numbers, compressed: high bytes of word numbers are mostly zero."""
    if not len(x):
        return b""
    return zstandard.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes(), 3)


def _unpack(raw: bytes, kind) -> np.ndarray:
    if not raw:
        return np.empty(0, kind)
    data = np.frombuffer(zstandard.decompress(raw), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(data.reshape(width, -1).T).reshape(-1).view(kind)


def _batch(rows):
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["bucket", "block", "part", "ids", "sizes", "body"])


def _blocks(batches):
    """``(words, documents)`` of each block: distinct words in order, and ``(row, word numbers)`` of its texts."""
    index, docs, size = Index(), [], 0
    for b in batches:
        for i, body in zip(b.column("row").to_pylist(), b.column("body")):
            raw = body.as_py()
            docs.append((i, index.codes(raw)))
            size += len(raw)
            if size > BLOCK_BYTES or len(index) > BLOCK_WORDS:
                yield list(index), docs
                index, docs, size = Index(), [], 0
    if docs:
        yield list(index), docs


def _name(words: list[bytes]) -> int:
    """A block goes by its list of words: equal lists number words alike, so they may share their ids."""
    return xxhash.xxh3_64_intdigest(b"\n".join(words)) >> 1


def _word_rows(words: list[bytes], name: int, buckets: int):
    """Words of a block for each bucket (``part`` 0); ``ids`` has their numbers in the block."""
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in words), np.int64, len(words))
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        mine = order[cuts[b]:cuts[b + 1]]
        if len(mine):
            body = zstandard.compress(b"\n".join([words[i] for i in mine.tolist()]), 3)
            yield _batch([(b, name, 0, _pack(mine.astype(np.uint32)), b"", body)])


def _position_rows(docs: list, name: int, bucket: int):
    """Texts of a block as numbers of words (``part`` 1); ``ids`` has the rows, ``sizes`` their word counts."""
    at = 0
    while at < len(docs):
        to, n = at, 0
        while to < len(docs) and (to == at or n < _ROW_WORDS):
            n += len(docs[to][1])
            to += 1
        part = docs[at:to]
        yield _batch([(bucket, name, 1, _pack(np.array([i for i, _ in part], np.int64)), _pack(np.array([len(c) for _, c in part], np.int64)),
                       _pack(np.concatenate([c for _, c in part])))])
        at = to


def _split(buckets: int, words_too: bool, positions_too: bool):
    def run(batches):
        for words, docs in _blocks(batches):
            name = _name(words)
            if words_too:
                yield from _word_rows(words, name, buckets)
            if positions_too:
                yield from _position_rows(docs, name, name % buckets)
    return run


def _encode(path: str):
    """Words become ids. All rows of a bucket are here, so each of its words is encoded once. Positions pass unchanged."""
    def run(batches):
        known: dict[bytes, bytes] = {}
        for b in batches:
            for bucket, block, part, ids, packed, body in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                if part:
                    yield _batch([(bucket, block, part, ids, packed, body)])
                    continue
                words = zstandard.decompress(body).split(b"\n")
                new = [w for w in words if w not in known]
                if len(known) + len(new) > _KNOWN:
                    known, new = {}, words
                flat, n = tokens.encode_words(new, path)
                raw, ends = flat.tobytes(), (4 * np.cumsum(n)).tolist()
                known.update(zip(new, (raw[e - 4 * k:e] for e, k in zip(ends, n.tolist()))))
                found = [known[w] for w in words]
                sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
                yield _batch([(bucket, block, part, ids, _pack(sizes.astype(np.int32)), _pack(np.frombuffer(b"".join(found), np.uint32)))])
    return run


def assembled(batches):
    """Rows of one block after the other, words (part 0) before positions."""
    block, number, flat, size = None, [], [], []
    start = sizes = ids = None
    for b in batches:
        rows, out, held = zip(*(b.column(c).to_pylist() for c in b.schema.names)), [], 0
        for _, at, part, doc, n, body in rows:
            if at != block:
                block, number, flat, size, start = at, [], [], [], None
            if part == 0:
                number.append(_unpack(doc, np.uint32))
                size.append(_unpack(n, np.int32))
                flat.append(_unpack(body, np.uint32))
                continue
            if start is None:
                word = np.concatenate(number) if number else np.empty(0, np.uint32)
                have = np.concatenate(size).astype(np.int64) if size else np.empty(0, np.int64)
                ids = np.concatenate(flat) if flat else np.empty(0, np.uint32)
                first = np.concatenate([[0], np.cumsum(have)[:-1]]) if len(have) else have
                most = int(word.max()) + 1 if len(word) else 0
                start, sizes = np.zeros(most, np.int64), np.full(most, -1, np.int64)
                start[word], sizes[word] = first, have
                if (sizes < 0).any():
                    raise RuntimeError("a block lacks ids of some words")
                number, flat, size = [], [], []
            words = _unpack(body, np.int32)
            counts = _unpack(n, np.int64)
            if len(words) and words.max() >= len(start):
                raise RuntimeError("a block was cut otherwise than its words")
            begin = 0
            for i, c in zip(_unpack(doc, np.int64).tolist(), counts.tolist()):
                mine = words[begin:begin + c]
                begin += c
                got = tokens.gather(ids, start[mine], sizes[mine]).astype("<u4").tobytes()
                out.append((i, len(got) // 4, got))
                held += len(got)
                if held > 16 << 20:
                    yield _encoded(out)
                    out, held = [], 0
        if out:
            yield _encoded(out)


def _encoded(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary()))], names=["row", "n_tokens", "ids"])


#: Stands for a null id on the way.
NO_ID = -(1 << 63)


def placed(docs: DataFrame, path: str, id_col: str, text_col: str, buckets: int | None, reread: bool) -> DataFrame:
    """Blocks with the ids of their words and the positions of their texts, block by block, for :func:`assembled`."""
    buckets = buckets or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID).cast("long")).alias("row"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("body"))
    words = rows.mapInArrow(_split(buckets, True, not reread), _ROW).repartition(buckets, "bucket").mapInArrow(_encode(path), _ROW)
    if reread:
        words = words.unionByName(rows.mapInArrow(_split(buckets, False, True), _ROW))
    return words.repartition(buckets, "block").sortWithinPartitions("block", "part")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
           buckets: int | None = None, reread: bool = True) -> DataFrame:
    """``id, n_tokens, ids`` per row of ``docs``; ``ids`` are little-endian unsigned 32-bit numbers.

    As the library's ``encode(text, add_special_tokens=False)``. Null and blank texts have no ids. Every row gives a row,
    repeated ids too; a null id stays null. Other columns are not read. An empty table gives no rows. Positions are made by
    reading the texts a second time; without ``reread`` they travel with the words: less work, more shuffled bytes.
    """
    back = placed(docs, path or tokens.public(), id_col, text_col, buckets, reread)
    return back.mapInArrow(assembled, "row long, n_tokens long, ids binary").select(
        F.when(F.col("row") != NO_ID, F.col("row")).alias("id"), "n_tokens", "ids")


def _decode(path: str):
    def run(batches):
        piece = tokens.pieces(path).__getitem__
        for b in batches:
            rest = [c for c in b.schema.names if c != "ids"]
            texts, at = [], 0
            ids = b.column("ids")
            for k, x in enumerate(ids):
                texts.append(b" ".join(map(piece, np.frombuffer(x.as_py(), "<u4").tolist())) if x.is_valid else None)
                if sum(map(len, texts[-50:])) > 8 << 20 or k - at > 500 or k == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [*[b.column(c).slice(at, len(texts)) for c in rest], pa.array(texts, pa.binary())], names=[*rest, "text"])
                    texts, at = [], k + 1
    return run


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` with ``text`` in place of ``ids``: each id joined with its piece, pieces separated by spaces, which is
    what the library's ``decode(ids, skip_special_tokens=False)`` gives for a tokenizer without a decoder. Null ids
    give a null text. The table of pieces has the size of the vocabulary."""
    path = path or tokens.public()
    keep = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema if f.name != "ids")
    return encoded.mapInArrow(_decode(path), f"{keep}, text binary").withColumn("text", F.col("text").cast("string"))
