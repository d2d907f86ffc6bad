"""Words of raw UTF-8 bytes, and hashes of runs of words, vectorised per document.

A word is a run of bytes other than the six ASCII blanks (space, tab, line feed, vertical tab, form feed, return), which
is what ``bytes.split()`` gives.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_SLICE = 1 << 22
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def pieces(raw: bytes) -> Iterator[bytes]:
    """``raw`` in pieces of a few megabytes, cut at blanks."""
    at = 0
    while len(raw) - at > _SLICE:
        cut = _BLANK.search(raw, at + _SLICE)
        end = cut.start() if cut else len(raw)
        yield raw[at:end]
        at = end
    if at < len(raw):
        yield raw[at:] if at else raw


def runs(raw: bytes) -> Iterator[list[bytes]]:
    """The words of ``raw`` in order, a list for each few megabytes, so that a huge text is never split all at once."""
    return (piece.split() for piece in pieces(raw))


def lower_words(bodies) -> Iterator[tuple[np.ndarray, pa.BinaryArray, np.ndarray]]:
    """``(text, words, at)`` for every few megabytes of a column of texts, A-Z in lower case: the distinct words, and for each
    word in turn the number of its text and its place among them."""
    group, held = [], 0

    def stretch():
        # views as strings, which nothing here takes for UTF-8
        lower = pc.ascii_lower(pa.array([x for _, x in group], pa.binary()).view(pa.string()))
        parts = pc.ascii_split_whitespace(lower)
        coded = parts.flatten().dictionary_encode()
        at, words = coded.indices.to_numpy(), coded.dictionary
        text = np.repeat(np.array([k for k, _ in group], np.int32), pc.list_value_length(parts).to_numpy())
        none = pc.index(words, "").as_py()  # before a blank that a text begins with, and after one at its end
        if none >= 0:
            there = at != none
            text, at = text[there], at[there]
            at = at - (at > none)
            words = pa.concat_arrays([words.slice(0, none), words.slice(none + 1)])
        return text, words.view(pa.binary()), at

    for k, body in enumerate(bodies):
        for piece in pieces(body.as_py()):
            group.append((k, piece))
            held += len(piece)
            if held > _SLICE:
                yield stretch()
                group, held = [], 0
    if group:
        yield stretch()


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word."""
    digest = xxhash.xxh3_64_intdigest
    parts = [np.fromiter(map(digest, ws), np.uint64, len(ws)) for ws in runs(raw)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.uint64)


def hashes_and_text(raw: bytes) -> tuple[np.ndarray, bytes]:
    """What :func:`word_hashes` gives, and the words joined by one blank, from splitting ``raw`` once."""
    digest, parts, texts = xxhash.xxh3_64_intdigest, [np.empty(0, np.uint64)], []
    for ws in runs(raw):
        if ws:
            parts.append(np.fromiter(map(digest, ws), np.uint64, len(ws)))
            texts.append(b" ".join(ws))
    return parts[-1] if len(parts) <= 2 else np.concatenate(parts), b" ".join(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Each bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        size = max(1 << 12, 1 << (n - 1).bit_length())
        both = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        _powers[base] = both[0], both[1]
    up, down = _powers[base]
    return up[:n], down[:n]


def window_hashes(h: np.ndarray, k: int, which: int = 0) -> np.ndarray:
    """A hash of every ``k`` consecutive entries of ``h``: a polynomial modulo 2^64 from prefix sums, then mixed.

    ``which`` 0 and 1 are independent of each other, for 128 bits together.
    """
    n = len(h)
    if n < k:
        return np.empty(0, np.uint64)
    up, down = _power(_BASES[which], n)
    if which:
        h = mix(h ^ np.uint64(_BASES[0]))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up, out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


class Index(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word):
        self[word] = n = len(self)
        return n

    def codes(self, raw: bytes, lower: bool = False) -> np.ndarray:
        """The number of each word of ``raw``."""
        at = self.__getitem__
        parts = [np.fromiter(map(at, ws), np.int32, len(ws)) for ws in runs(raw.lower() if lower else raw)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, np.int32)


def word_grams(words: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the byte n-grams of ``" word "`` that end in each byte after the first, and the word each belongs to.

    A code has the predicted byte in its lowest eight bits, the byte before it in the next eight and so on; places before
    the word are zero.
    """
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    data = np.frombuffer(b"".join([b" " + w for w in words]) + b" ", np.uint8).astype(np.uint64)
    begin = np.cumsum(sizes) - sizes
    word = np.repeat(np.arange(len(words)), sizes)
    inside = np.arange(int(sizes.sum())) - begin[word] + 1  # bytes of the word before the predicted one
    last = data[1:].copy()  # after a word stands the blank of the next one
    codes = last
    for back in range(1, order):
        before = np.zeros(len(last), np.uint64)
        before[back - 1:] = data[: max(0, len(last) - back + 1)]
        codes = codes | (np.where(inside >= back, before, 0).astype(np.uint64) << np.uint64(8 * back))
    return codes, word


def find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in a sorted table the keys stand, and whether they are there."""
    at = np.searchsorted(table, keys)
    at[at == len(table)] = 0
    return at, (table[at] == keys) if len(table) else np.zeros(len(keys), bool)


#: Odd numbers; the high bits of a key's product with one of them are its slot.
_SLOTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


class Slots:
    """Finds keys in a sorted table as :func:`find` does. A key stands in a slot of one of a few hash tables, each for what the
    one before could not place; the few keys that none has placed are searched for."""

    def __init__(self, table: np.ndarray):
        self.table, self.levels = table, []
        left = np.arange(len(table), dtype=np.int32)
        for factor in _SLOTS:
            if not len(left):
                break
            shift = np.uint64(63 - len(left).bit_length())
            at = np.zeros(1 << (64 - int(shift)), np.int32)
            slot = (table[left] * np.uint64(factor)) >> shift
            at[slot] = left
            self.levels.append((np.uint64(factor), shift, at))
            left = left[at[slot] != left]
        self.left = left

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in the table the keys stand, and whether they are there."""
        out, hit, open_ = np.zeros(len(keys), np.int32), np.zeros(len(keys), bool), None
        for factor, shift, at in self.levels:
            asked = keys if open_ is None else keys[open_]
            here = at[(asked * factor) >> shift]
            found = self.table[here] == asked
            if open_ is None:
                out, hit, open_ = here, found, np.flatnonzero(~found)
            else:
                out[open_[found]], hit[open_[found]] = here[found], True
                open_ = open_[~found]
        if len(self.left):
            here, found = find(self.table[self.left], keys[open_])
            out[open_[found]], hit[open_[found]] = self.left[here[found]], True
        return out, hit
