"""Frequent words that tasks look up in memory: some as they are, many more by a hash that no other word shares."""

from __future__ import annotations

from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import Slots

#: Words that are held as they are, none longer than this many bytes.
HEAD, HEAD_BYTES = 1 << 17, 64
#: Words that are held by their hash at most, eight bytes and a number each.
MORE = 1 << 20
_SEED = 42


class Frequent(NamedTuple):
    """Words and their numbers, and sorted hashes of words, these among them, with theirs."""

    words: list[bytes]
    numbers: np.ndarray
    hashes: np.ndarray
    more: np.ndarray


class Places(dict):
    """The places of words in a list; -1 for any other."""

    def __init__(self, words: list[bytes]):
        super().__init__((w, i) for i, w in enumerate(words))

    def __missing__(self, word):
        return -1


def hashes(words) -> np.ndarray:
    """What :func:`word_hash` gives for each word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words, repeat(_SEED)), np.uint64, len(words))


def word_hash() -> Column:
    return F.xxhash64("word")  # its seed is _SEED


def least_count(rows: DataFrame, count: str, most: int) -> tuple[int, bool]:
    """The count from which on at most ``most`` rows have it, and whether all rows with a count do."""
    size = F.floor(F.log2(count) * 8)  # eight rows per power of two
    sizes = {r["size"]: (r["rows"], r["least"]) for r in rows.where(F.col(count) > 0).groupBy(size.alias("size")).agg(F.count(F.lit(1)).alias("rows"), F.min(count).alias("least")).collect()}
    least, held = 1 << 62, 0
    for s in sorted(sizes, reverse=True):
        held += sizes[s][0]
        if held > most:
            return least, False
        least = sizes[s][1]
    return least, True


def _among(held: Broadcast):
    def run(batches):
        slots = Slots(held.value)
        for b in batches:
            _, hit = slots.find(b.column("hash").to_numpy().view(np.uint64))
            yield b.filter(pa.array(hit))
    return run


def frequent(words: DataFrame, count: str, number: str, head: int = HEAD, more: int = MORE) -> Frequent:
    """Of ``words`` (``word``, its ``count`` and its ``number``, a held table with each word once) ``head`` of the most frequent
    as they are, and ``more`` at most by hash.

    A hash that any two words of the table share is left out, so a word of the table that finds its hash finds its number.
    """
    top = words.where(F.octet_length("word") <= HEAD_BYTES).orderBy(F.col(count).desc(), "word").limit(head).select("word", number).toArrow()
    least, _ = least_count(words, count, more)
    kept = words.where(F.col(count) >= least).select(word_hash().alias("hash"), number).toArrow()  # ``more`` at most
    table, first, n = np.unique(kept["hash"].to_numpy().view(np.uint64), return_index=True, return_counts=True)
    held = words.sparkSession.sparkContext.broadcast(table)
    others = words.where(F.col(count) < least).select(word_hash().alias("hash")).mapInArrow(_among(held), "hash long").toArrow()  # next to none
    alone = (n == 1) & ~np.isin(table, others["hash"].to_numpy().view(np.uint64))
    held.destroy()
    return Frequent(top["word"].to_pylist(), top[number].to_numpy(), table[alone], kept[number].to_numpy()[first[alone]])
