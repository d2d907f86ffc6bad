"""Importance resampling towards a target distribution: hashed n-gram weights, then a radix sort of all documents.

Texts become runs of one to three words, hashed into a fixed number of buckets. A bucket's gain is the logarithm of how much more
likely the target makes it than the corpus; an array of gains scores every document. With Gumbel noise on the weights the largest
scores are a sample without replacement, and ranks come from a distributed LSD radix sort: passes over the digits of (score, id),
each a stable counting sort whose destinations follow from prefix sums of digit counts over all blocks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import hold
from .words import Index

BUCKETS = 10_000
#: Bytes that are part of words, A-Z as a-z, and all others as blanks; fixed values.
_TABLE = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
#: Words that a task remembers at a time, and bytes of text that it looks at together.
_KNOWN, _GROUP = 300_000, 4 << 20
#: Bits of a digit, and rows of a block of positions.
DIGIT, ROWS = 12, 1 << 20
_POLYNOMIAL = 0xEDB88320
_SHORT = 64


def _bytes_behind(shift: int) -> np.ndarray:
    """What ``shift`` zero bytes behind a text make of its CRC-32 register, per byte of the register: a 4 x 256 table."""
    low = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        low = np.where(low & 1, (low >> 1) ^ np.uint32(_POLYNOMIAL), low >> 1).astype(np.uint32)
    value = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    for _ in range(shift):
        value = (value >> np.uint32(8)) ^ low[value & np.uint32(0xFF)]
    return value


def _shifts() -> np.ndarray:
    """:func:`_bytes_behind` for 0 to ``_SHORT`` bytes."""
    one = _bytes_behind(1)
    out = [_bytes_behind(0)]
    for _ in range(_SHORT):
        out.append(_moved(out[-1], one))
    return np.stack(out)


def _moved(crc: np.ndarray, table: np.ndarray) -> np.ndarray:
    parts = [table[k][crc >> np.uint32(8 * k) & np.uint32(0xFF)] for k in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


class Features:
    """Buckets of the word runs of texts. CRC-32 is linear, so the hash of a run follows from those of its words: every new word
    is hashed once, alone and behind a blank, and a longer run moves what is before the word by the word's bytes."""

    def __init__(self, most_words: int = 3, buckets: int = BUCKETS):
        self.most_words, self.buckets = most_words, buckets
        self.shifts = _shifts().reshape(_SHORT + 1, 4 * 256)
        self.flat = self.shifts.ravel()
        self._forget()

    def _forget(self):
        self.index = Index()
        self.alone = self.behind = np.empty(0, np.uint32)
        self.size = np.empty(0, np.int64)

    def _learn(self):
        new = list(self.index)[len(self.size):] if len(self.index) > len(self.size) else []
        if new:
            alone = np.fromiter(map(zlib.crc32, new), np.uint32, len(new))
            behind = np.fromiter((zlib.crc32(b" " + w) for w in new), np.uint32, len(new))
            size = np.fromiter(map(len, new), np.int64, len(new)) + 1
            self.alone, self.behind, self.size = (np.concatenate(x) for x in ((self.alone, alone), (self.behind, behind), (self.size, size)))

    def _append(self, crc: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The hash of a text with hash ``crc``, a blank and a word."""
        size = self.size[code]
        at = np.minimum(size, _SHORT) * 1024
        moved = np.zeros(len(crc), np.uint32)
        for k in range(4):
            moved ^= self.flat[at + (256 * k) + (crc >> np.uint32(8 * k) & np.uint32(0xFF)).astype(np.int64)]
        for n in np.unique(size[size > _SHORT]):  # a table for each size of long words
            far = size == n
            moved[far] = _moved(crc[far], _power(int(n)))
        return moved ^ self.behind[code]

    def of(self, texts: Iterable[bytes]) -> Iterator[tuple[int, int, list[np.ndarray]]]:
        """Per text the number of words and of features, and the buckets of its features in pieces."""
        waiting, held = [], 0
        for text in texts:
            if len(self.index) > _KNOWN:
                yield from self._hashed(waiting)
                waiting, held = [], 0
                self._forget()
            waiting.append(self.index.codes(text.translate(_TABLE)))
            held += len(text)
            if held > _GROUP:
                yield from self._hashed(waiting)
                waiting, held = [], 0
        yield from self._hashed(waiting)

    def _hashed(self, texts):
        self._learn()
        if not texts:
            return
        n = np.array([len(x) for x in texts])
        code = np.concatenate(texts)
        ends = np.cumsum(n)
        inside = np.arange(len(code)) - np.repeat(ends - n, n)  # words before this one
        crc = self.alone[code]
        levels = [crc % np.uint32(self.buckets)]
        open_ = np.arange(len(code))
        for k in range(1, self.most_words):
            # runs that end in a word: those that end in the word before, and the word
            open_ = open_[inside[open_] >= k]
            longer = np.zeros(len(code), np.uint32)
            longer[open_] = self._append(crc[open_ - 1], code[open_])
            crc = longer
            levels.append(crc % np.uint32(self.buckets))
        for words, end in zip(n.tolist(), ends.tolist()):
            begin = end - words
            parts = [level[begin + k:end] for k, level in enumerate(levels) if words > k]
            yield words, sum(map(len, parts)), parts


_powers: dict[int, np.ndarray] = {}


def _power(n: int) -> np.ndarray:
    """:func:`_bytes_behind` for any number, by doubling."""
    if n not in _powers:
        if len(_powers) > 256:
            _powers.clear()
        if n <= 1:
            _powers[n] = _bytes_behind(n)
        else:
            half = _power(n // 2)
            both = _moved(half, half)
            _powers[n] = _moved(both, _power(1)) if n % 2 else both
    return _powers[n]


def _raw(text_col: str) -> Column:
    return F.coalesce(F.col(f"`{text_col}`").cast("string").cast("binary"), F.lit(b"")).alias("body")


def _count(most_words: int, buckets: int):
    def run(batches):
        features, total = Features(most_words, buckets), np.zeros(buckets, np.int64)
        for b in batches:
            for _, _, parts in features.of(x.as_py() for x in b.column("body")):
                for p in parts:
                    total += np.bincount(p, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])
    return run


def bucket_counts(docs: DataFrame, text_col: str = "text", most_words: int = 3, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts by bucket; a task sends a row per bucket, and the driver gets one each."""
    rows = docs.select(_raw(text_col)).mapInArrow(_count(most_words, buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets))))`` per bucket, in doubles."""
    of, to = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * of / ((s + 1) * to))) for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def _weigh(gain: np.ndarray, most_words: int):
    def run(batches):
        features = Features(most_words, len(gain))
        for b in batches:
            rows = [(words, n, sum(int(gain[p].sum()) for p in parts)) for words, n, parts in features.of(x.as_py() for x in b.column("body"))]
            numbers = np.array(rows, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column("id"), *[pa.array(numbers[:, k]) for k in range(3)]], names=["id", "words", "n_features", "weight"])
    return run


def gumbel(ident: Column, seed: int = 42) -> Column:
    """``floor(-1000 ln(-ln((h + 0.5) / 2^32)))`` with ``h`` the first 32 bits of sha256 of the seed and the id, null as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def radix_ranks(rows: DataFrame, keys: list[Column], name: str = "ranks") -> DataFrame:
    """``rows`` (without columns ``position`` and ``_...``) with ``position``: their place, from 0, in the ascending order of ``keys`` (longs, the first counts most).

    Least significant digit first: a pass gives every row the number of rows with a smaller digit, with its digit in earlier
    blocks of positions, and with its digit before it in its block. A block has ``ROWS`` positions, and blocks are what is
    shuffled, so no key lands in one task however often it occurs; digit counts by block are a small table, summed up by
    windows over the blocks of a digit. Digits in which all rows agree are left out. The table is written
    after every pass, so a lost executor costs one pass.
    """
    # as unsigned numbers with the sign bit turned, keys compare by their bits
    flipped = [k.cast("long").bitwiseXOR(F.lit(-(1 << 63)).cast("long")).alias(f"_k{i}") for i, k in enumerate(keys)]
    table = hold(rows.select(*[F.col(f"`{c}`") for c in rows.columns], *flipped, F.monotonically_increasing_id().alias("position")), name)
    ends = table.agg(*[f(f"_k{i}") for i in range(len(keys)) for f in (F.bit_and, F.bit_or)]).first()
    out = [F.col(f"`{c}`") for c in rows.columns] + [F.col(f"_k{i}") for i in range(len(keys))]
    block = F.shiftright("position", 33)  # at first a partition is a block
    ranked = False
    for i in reversed(range(len(keys))):
        low, high = ends[2 * i], ends[2 * i + 1]
        differ = 0 if low is None else (low ^ high) & ((1 << 64) - 1)
        shift = 0
        while differ >> shift:
            shift += (differ >> shift & -(differ >> shift)).bit_length() - 1  # bits in which all agree
            table = hold(_pass(table, F.shiftrightunsigned(f"_k{i}", shift).bitwiseAND(F.lit((1 << DIGIT) - 1)).cast("int"), block, out), name)
            block, ranked = F.floor(F.col("position") / ROWS), True
            shift += DIGIT
    if not ranked:  # all keys are equal
        table = _pass(table, F.lit(0), block, out)
    return table.select(*out[:len(rows.columns)], "position")


def _pass(table: DataFrame, digit: Column, block: Column, out: list[Column]) -> DataFrame:
    """A stable counting sort by ``digit``: the same rows with their new ``position``."""
    rows = table.withColumns({"_block": block.cast("long"), "_digit": digit})
    counts = hold(rows.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("n")), "radix-counts")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    # 2 ^ DIGIT rows at most, so one task may have them all
    smaller = counts.groupBy(F.col("_digit").alias("_each")).agg(F.sum("n").alias("n")).select(
        "_each", F.coalesce(F.sum("n").over(before.orderBy("_each")), F.lit(0)).alias("_smaller"))
    earlier = F.coalesce(F.sum("n").over(before.partitionBy("_digit").orderBy("_block")), F.lit(0))
    first = counts.withColumn("_earlier", earlier).join(smaller, F.col("_digit") == F.col("_each")).select(
        F.col("_digit").alias("_of"), F.col("_block").alias("_in"), (F.col("_smaller") + F.col("_earlier")).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("position")) - 1
    placed = rows.withColumn("_inside", inside).join(first, (F.col("_block") == F.col("_in")) & (F.col("_digit") == F.col("_of")))
    return placed.select(*out, (F.col("_first") + F.col("_inside")).cast("long").alias("position"))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, most_words: int = 3, buckets: int = BUCKETS, seed: int = 42,
    id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
) -> DataFrame:
    """``id, n_features, weight, score, rank`` for every row of ``docs``; the ``percent`` of the documents with at least
    ``least_words`` words that have the largest scores, ties to the smaller id, get ranks from 1, all others null.

    A null text has no words, no features and weight 0. Null ids share the noise of the empty id, stay null and rank behind
    all ids of their score; rows that repeat are documents each. Other columns are not read. An empty target gives every
    bucket its share without counts; an empty table gives no rows. The driver gets a count per bucket.
    """
    gain = gains(bucket_counts(docs, text_col, most_words, buckets), bucket_counts(target, target_col, most_words, buckets))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _raw(text_col))
    weighed = rows.mapInArrow(_weigh(gain, most_words), "id long, words long, n_features long, weight long")
    scored = hold(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "resampling-scores")
    long_ = F.col("words") >= least_words
    n, top = scored.where(long_).agg(F.count(F.lit(1)), F.max("score")).first()
    columns = ["id", "n_features", "weight", "score"]
    if not n * percent // 100:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    falling = F.lit(top) - F.col("score")
    last = F.when(F.col("id").isNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    ranked = radix_ranks(scored.where(long_).select(*columns), [falling, last, F.coalesce("id", F.lit(0))], "resampling-ranks")
    place = F.when(F.col("position") < n * percent // 100, F.col("position") + 1)
    short = scored.where(~long_).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, place.alias("rank")).unionByName(short)


def drawn(docs: DataFrame, resampled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs``, all columns, whose id has a rank in :func:`resample`; rows that share an id come together, rows
    without one do not come."""
    chosen = resampled.where("rank is not null and id is not null").select(F.col("id").alias("_drawn")).distinct()
    return docs.join(chosen, F.col(f"`{id_col}`").cast("long") == F.col("_drawn"), "left_semi")
