"""Tokenizer files on the workers. A file's path is a parameter; every node has the package that names it."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np

from .words import Index, runs


def public(name: str = "word_bpe_49k.json") -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def pieces(path: str) -> tuple[bytes, ...]:
    """The piece of every id: as many rows as the vocabulary, whatever the input."""
    t = tokenizer(path)
    return tuple((t.id_to_token(i) or "").encode() for i in range(t.get_vocab_size(with_added_tokens=True)))


#: Words are encoded in lines of this many; longer words than this many bytes stand alone.
_LINE_WORDS, _LINE_BYTES = 512, 256


def _one_by_one(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    found = tokenizer(path).encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
    ids = [e.ids for e in found]
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes


def _by_line(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """ASCII words as lines of text: a piece belongs to the word in which it starts."""
    encode, flat, sizes = tokenizer(path).encode, [], []
    for at in range(0, len(words), _LINE_WORDS):
        line = words[at:at + _LINE_WORDS]
        found = encode(b" ".join(line).decode(), add_special_tokens=False)
        ends = np.cumsum(np.fromiter(map(len, line), np.int64, len(line)) + 1)
        starts = np.fromiter((o[0] for o in found.offsets), np.int64, len(found))
        sizes.append(np.bincount(np.searchsorted(ends, starts, side="right"), minlength=len(line)))
        flat.append(np.array(found.ids, np.uint32))
    return np.concatenate(flat), np.concatenate(sizes)


def encode_words(words: list[bytes], path: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the words one after the other, and how many each has.

    The tokenizer drops blanks and lets no piece span them, so a text's ids are those of its words in order. Short ASCII
    words are encoded line by line; words that a normaliser may change in length, or that may hold an added token, alone.
    """
    plain = np.fromiter((w.isascii() and len(w) < _LINE_BYTES and b"<" not in w for w in words), bool, len(words))
    flat, start, sizes = np.empty(0, np.uint32), np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    for chosen, way in ((np.flatnonzero(plain), _by_line), (np.flatnonzero(~plain), _one_by_one)):
        if len(chosen):
            found, n = way([words[i] for i in chosen.tolist()], path)
            start[chosen], sizes[chosen] = len(flat) + np.cumsum(n) - n, n
            flat = np.concatenate([flat, found])
    return (flat if plain.all() else gather(flat, start, sizes)), sizes


def gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches ``flat[start:start + size]`` one after the other."""
    total = int(size.sum())
    if not total:
        return flat[:0]
    at = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total)
    return flat[at]


class WordEncoder:
    """Ids of whole texts in a task: each new word is encoded once and remembered, up to a bound."""

    known_words = 300_000
    group_bytes = 8 << 20

    def __init__(self, path: str):
        self.path = path
        self._forget()

    def _forget(self):
        self.index, self.flat = Index(), np.empty(0, np.uint32)
        self.start = self.size = np.empty(0, np.int64)

    def _learn(self):
        new = list(islice(self.index, len(self.size), None))
        if new:
            flat, size = encode_words(new, self.path)
            start = len(self.flat) + np.cumsum(size) - size
            self.flat, self.start, self.size = (np.concatenate(x) for x in ((self.flat, flat), (self.start, start), (self.size, size)))

    def texts(self, bodies: Iterable[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text in turn."""
        waiting: list[list[np.ndarray]] = []
        held = 0

        def numbers(codes):
            return gather(self.flat, self.start[codes], self.size[codes])

        for body in bodies:
            parts: list[np.ndarray] = []
            for ws in runs(body):
                codes = np.fromiter(map(self.index.__getitem__, ws), np.int32, len(ws))
                if len(body) > self.group_bytes or len(self.index) > self.known_words:
                    # what waits is turned into ids before the words are forgotten
                    self._learn()
                    waiting = [[x if x.dtype == np.uint32 else numbers(x) for x in w] for w in waiting]
                    parts = [x if x.dtype == np.uint32 else numbers(x) for x in parts]
                    codes = numbers(codes)
                    if len(self.index) > self.known_words:
                        self._forget()
                parts.append(codes)
            waiting.append(parts)
            held += len(body)
            if held > self.group_bytes:
                self._learn()
                for w in waiting:
                    yield np.concatenate([x if x.dtype == np.uint32 else numbers(x) for x in w]) if w else np.empty(0, np.uint32)
                waiting, held = [], 0
        self._learn()
        for w in waiting:
            yield np.concatenate([x if x.dtype == np.uint32 else numbers(x) for x in w]) if w else np.empty(0, np.uint32)
