"""Source divergence audit: term counts of every source from sorted token pointers, compared within a language.

A task lays a slice of its documents out in one buffer, group by group, finds where words start, and sorts these pointers by
multikey quicksort, eight bytes of every word at a time: runs that agree so far are sorted by their next eight bytes
until they agree in whole words. Equal runs are the terms; inside a run pointers ascend, so a source's occurrences
and documents lie together and are counted by the run's bounds. Only these counts are shuffled.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staging import hold

#: Bytes of text that are laid out and sorted at once, if several documents share them.
SLICE = 8 << 20
#: Steps of eight bytes after which the few words that still agree are compared whole.
_STEPS = 8
#: Sources that are compared with as many others at a time.
BLOCK = 512
_TERMS = 2048
SHARE = 1_000_000_000

#: Bytes of words as they count, 0 for all others: letters a-z, A-Z as a-z, and what is not ASCII; fixed values.
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[:0x41] = _LETTER[0x5B:0x61] = _LETTER[0x7B:0x80] = 0
_LETTER[0x41:0x5B] += 0x20


def word_pointers(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The buffer with :data:`_LETTER` applied and eight zero bytes behind it, and start and size of every word in it.

    ``begin`` has the first byte of every document; words do not cross documents.
    """
    text = np.zeros(len(data) + 8, np.uint8)
    np.take(_LETTER, data, out=text[:len(data)])
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = text[:len(data)] != 0
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    border = begin[begin < len(data)]
    starts[border] = inside[border]
    ends[border[border > 0] - 1] = inside[border[border > 0] - 1]
    start = np.flatnonzero(starts)
    return text, start, np.flatnonzero(ends) + 1 - start


def sort_pointers(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the words by their bytes, equal ones by position, and which of them begins a run of equal words."""
    n = len(start)
    at = np.arange(n)
    head = np.ones(n, bool)
    if not n:
        return at, head
    eight = np.ndarray(len(text) - 7, ">u8", text, strides=(1,))
    mask = np.array([0] + [0xFFFFFFFFFFFFFFFF << 8 * (8 - k) & 0xFFFFFFFFFFFFFFFF for k in range(1, 9)], np.uint64)
    open_ = at.copy()  # places of the order in runs of several words that may differ later on
    run = np.zeros(n, np.int64)
    for step in range(_STEPS):
        word = at[open_]
        rest = np.minimum(np.maximum(size[word] - 8 * step, 0), 8)
        key = eight[np.minimum(start[word] + 8 * step, len(text) - 8)].astype(np.uint64) & mask[rest]
        by = np.argsort(key, kind="stable") if step == 0 else np.lexsort((key, run))
        at[open_], key, run = word[by], key[by], run[by]
        new = np.ones(len(open_), bool)
        new[1:] = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        head[open_] = new
        run = np.cumsum(new) - 1
        # a run goes on if it has several words and its longest has bytes left
        more = np.bincount(run, size[at[open_]] > 8 * (step + 1), run[-1] + 1) * (np.bincount(run) > 1)
        keep = more[run] > 0
        open_, run = open_[keep], run[keep]
        if not len(open_):
            return at, head
    raw = text.tobytes()
    whole = [(r, raw[start[w] + 8 * _STEPS:start[w] + size[w]], w) for r, w in zip(run.tolist(), at[open_].tolist())]
    whole.sort()
    at[open_] = [w for _, _, w in whole]
    head[open_] = [k == 0 or whole[k][:2] != whole[k - 1][:2] for k in range(len(whole))]
    return at, head


def _counts(data: np.ndarray, begin: np.ndarray, group: np.ndarray):
    """``(group, term, n, docs)`` for documents that ascend by group."""
    text, start, size = word_pointers(data, begin)
    at, head = sort_pointers(text, start, size)
    doc = np.searchsorted(begin, start, side="right") - 1  # empty documents share a border; the last one there has the words
    d = doc[at]
    g = group[d]
    first = head.copy()
    first[1:] |= g[1:] != g[:-1]
    fresh = first.copy()
    fresh[1:] |= d[1:] != d[:-1]
    cut = np.flatnonzero(first)
    if not len(cut):
        return np.empty(0, np.int64), pa.array([], pa.binary()), cut, cut
    n = np.diff(np.append(cut, len(at)))
    docs = np.add.reduceat(fresh.astype(np.int64), cut)
    one = at[cut]
    ends = np.cumsum(size[one])
    take = np.repeat(start[one] - (ends - size[one]), size[one]) + np.arange(ends[-1])
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(one), [None, pa.py_buffer(offsets), pa.py_buffer(text[take])])
    return g[cut], terms, n, docs


def _count_terms(batches):
    """A row per (language, source, term) of every slice."""
    for b in batches:
        columns = [b.column(c).cast(pa.large_binary()) for c in ("text", "lang", "source")]
        offsets = np.frombuffer(columns[0].buffers()[1], np.int64)[columns[0].offset:][:b.num_rows + 1]
        low = 0
        while low < b.num_rows:
            high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + SLICE, side="right")) - 1)
            text, lang, source = (c.slice(low, high - low) for c in columns)
            pairs, group = np.unique(_codes(lang) * (len(source) + 1) + _codes(source), return_inverse=True)
            order = np.argsort(group, kind="stable")
            text, group = text.take(pa.array(order)), group[order]
            at = np.frombuffer(text.buffers()[1], np.int64)[text.offset:][:len(text) + 1]
            data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[at[0]:at[-1]]
            g, terms, n, docs = _counts(data, at[:-1] - at[0], group)
            some = np.empty(len(pairs), np.int64)
            some[group] = order  # a row of each group
            yield pa.RecordBatch.from_arrays(
                [*[c.take(pa.array(some[g])).cast(pa.string()) for c in (lang, source)], terms.cast(pa.large_string()).cast(pa.string()),
                 pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))],
                names=["lang", "source", "term", "n", "docs"])
            low = high


def _codes(column) -> np.ndarray:
    return column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


class Audit(NamedTuple):
    """``terms``: lang, term, total and per source its count; ``groups``: lang, source, words, lang_words, kept."""

    terms: DataFrame
    groups: DataFrame


def count(docs: DataFrame, least_docs: int = 3, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> Audit:
    """The terms that at least ``least_docs`` documents of their language have, with their counts by source, and every
    (language, source) that occurs, also without terms, with its words among the kept terms, its language's, and the number
    of kept terms of the language. Null text, language and source count as empty; every row is a document, repeated or not.
    Other columns are not read; an empty table gives empty ones."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))])
    found = rows.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long")
    counts = hold(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "audit-counts")
    # an entry for each source that has the term
    terms = counts.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries"))
    terms = hold(terms.where(F.col("docs") >= least_docs).select("lang", "term", "total", "entries"), "audit-terms")
    langs = terms.groupBy(F.col("lang").alias("l")).agg(F.sum("total").alias("lang_words"), F.count(F.lit(1)).alias("kept"))
    words = terms.select("lang", F.explode("entries").alias("e")).groupBy(F.col("lang").alias("wl"), F.col("e.source").alias("ws")).agg(F.sum("e.n").alias("words"))
    zero = F.lit(0).cast("long")
    groups = (rows.select("lang", "source").distinct()
              .join(words, (F.col("lang") == F.col("wl")) & (F.col("source") == F.col("ws")), "left").join(langs, F.col("lang") == F.col("l"), "left")
              .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("words", "lang_words", "kept")]))
    return Audit(terms, hold(groups, "audit-groups"))


def share(n: Column, words: Column, kept: Column) -> Column:
    """``1 + floor(SHARE * (n + 1) / (words + kept))``, exact at any count; 1 if there are no kept terms."""
    wide = "decimal(38,0)"
    whole = F.call_function("div", F.lit(SHARE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), F.greatest(words + kept, F.lit(1)).cast(wide))
    return (1 + whole).cast("long")


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q) * (p - q) / q)``; shares are at most ``SHARE + 1``, so the product is a long."""
    return F.call_function("div", (p - q) * (p - q), q).cast("long")


def _shares(n: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """:func:`share` for arrays by long division in steps of a thousand: no product exceeds 1000 times ``whole``."""
    p, rest = np.divmod(n + 1, whole)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        p = p * 1000 + digit
    return 1 + p


def _compare(known: dict[str, dict[str, int]], size: dict[str, np.ndarray]):
    """Per pair of sources of a tile the sum of the gaps over its terms, and their number; ``known`` numbers the sources of a
    language, ``size`` has the denominators of their shares."""
    def run(batches):
        sums: dict[tuple, np.ndarray] = {}
        seen: dict[tuple, int] = {}
        for b in batches:
            lang, row, col = (b.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "i", "j"))
            entries = b.column("entries")
            sources, n = (entries.flatten().field(k) for k in range(2))
            ends = np.cumsum(entries.value_lengths().to_numpy(zero_copy_only=False))
            counts, names = n.to_numpy(zero_copy_only=False), sources.dictionary_encode()
            term = np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
            code = names.indices.to_numpy(zero_copy_only=False)
            for key in sorted(set(zip(lang.tolist(), row.tolist(), col.tolist()))):
                number = known[key[0]]
                index = np.array([number.get(s, -1) for s in names.dictionary.to_pylist()], np.int64)
                mine = np.flatnonzero((lang == key[0]) & (row == key[1]) & (col == key[2]))
                for low in range(0, len(mine), _TERMS):
                    few = mine[low:low + _TERMS]
                    place = np.full(len(ends), -1)
                    place[few] = np.arange(len(few))
                    own = place[term] >= 0
                    sides = []
                    for block in key[1:]:
                        whole = size[key[0]][block * BLOCK:(block + 1) * BLOCK]
                        p = np.zeros((len(whole), len(few)), np.int64)
                        s = index[code[own]] - block * BLOCK
                        ok = (s >= 0) & (s < len(whole))
                        p[s[ok], place[term[own]][ok]] = counts[own][ok]
                        sides.append(_shares(p, whole[:, None]))
                    p, q = sides
                    total = sums.setdefault(key, np.zeros((len(p), len(q)), np.int64))
                    for a in range(len(p)):
                        d = p[a] - q
                        total[a] += (d * d // q).sum(axis=1)
                    seen[key] = seen.get(key, 0) + len(few)
        for (name, i, j), total in sums.items():
            a, b = (x.ravel() for x in np.indices(total.shape))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * total.size, pa.string()), pa.array(a + i * BLOCK), pa.array(b + j * BLOCK), pa.array(total.ravel()),
                 pa.array(np.full(total.size, seen[name, i, j]))], names=["lang", "a", "b", "value", "terms"])
    return run


def pairs(audit: Audit) -> DataFrame:
    """``lang, source, item, value``: every source against every other of its language, the gaps summed over all kept terms.

    A term's counts are laid out for blocks of ``BLOCK`` by ``BLOCK`` sources, one of which has the term; terms that neither
    block has give the same gap each and are only counted. A row per source comes to the driver, as the result has one
    for each two of them.
    """
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = hold(audit.groups.withColumn("number", number.cast("long")), "audit-numbers")
    known: dict[str, dict[str, int]] = {}
    size: dict[str, list[int]] = {}
    for r in groups.orderBy("lang", "number").collect():
        known.setdefault(r["lang"], {})[r["source"]] = r["number"]
        size.setdefault(r["lang"], []).append(max(r["words"] + r["kept"], 1))
    sizes = {k: np.array(v, np.int64) for k, v in size.items()}
    blocks = max((len(v) - 1) // BLOCK + 1 for v in size.values()) if size else 1
    tiles = audit.terms.select("lang", "entries", F.lit(0).alias("i"), F.lit(0).alias("j"))
    if blocks > 1:
        names = groups.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), F.floor(F.col("number") / BLOCK).cast("int").alias("block"))
        last = groups.groupBy(F.col("lang").alias("ll")).agg(F.floor(F.max("number") / BLOCK).cast("int").alias("last"))
        own = (audit.terms.select("lang", "term", F.explode("entries").alias("e"))
               .join(names, (F.col("lang") == F.col("gl")) & (F.col("e.source") == F.col("gs")))
               .groupBy("lang", "term", "block").agg(F.collect_list("e").alias("entries")).groupBy("lang", "term")
               .agg(F.collect_list(F.struct("block", "entries")).alias("parts")).join(last, F.col("lang") == F.col("ll")))
        every = F.sequence(F.lit(0), F.col("last"))
        spread = own.withColumn("i", F.explode(every)).withColumn("j", F.explode(every))
        part = F.filter("parts", lambda x: (x["block"] == F.col("i")) | (x["block"] == F.col("j")))
        tiles = spread.select("lang", F.flatten(F.transform(part, lambda x: x["entries"])).alias("entries"), "i", "j").where(F.size("entries") > 0)
    sums = tiles.mapInArrow(_compare(known, sizes), "lang string, a long, b long, value long, terms long").groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("terms").alias("terms"))
    own, other = (groups.select(F.col("lang").alias(f"l{x}"), F.col("source").alias(f"s{x}"), F.col("number").alias(f"n{x}"), F.col("kept").alias(f"k{x}"),
                                share(F.lit(0).cast("long"), F.col("words"), F.col("kept")).alias(f"z{x}")) for x in "ab")
    both = own.join(other, (F.col("la") == F.col("lb")) & (F.col("na") != F.col("nb")))  # what the result consists of
    zero = F.lit(0).cast("long")
    value = F.coalesce("value", zero) + (F.col("ka") - F.coalesce("terms", zero)) * gap(F.col("za"), F.col("zb"))
    return both.join(sums, (F.col("la") == F.col("lang")) & (F.col("na") == F.col("a")) & (F.col("nb") == F.col("b")), "left").select(
        F.col("la").alias("lang"), F.col("sa").alias("source"), F.col("sb").alias("item"), value.alias("value"))


def typical_terms(audit: Audit, most: int = 200) -> DataFrame:
    """``lang, source, item, value, rank``: the ``most`` kept terms of every source whose share there exceeds their language's
    by the largest gap, ties by term; Spark cuts every task's list before the shuffle."""
    one = audit.terms.select("lang", "term", "total", F.explode("entries").alias("e")).select("lang", "term", "total", F.col("e.source").alias("source"), F.col("e.n").alias("n"))
    groups = audit.groups.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), "words", "lang_words", "kept")
    rows = one.join(groups, (F.col("lang") == F.col("gl")) & (F.col("source") == F.col("gs"))).withColumns({
        "p": share(F.col("n"), F.col("words"), F.col("kept")), "q": share(F.col("total"), F.col("lang_words"), F.col("kept"))})
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    above = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    return above.withColumn("rank", rank).where(F.col("rank") <= most)


def divergence(docs: DataFrame, most: int = 200, least_docs: int = 3, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, part, item, value, rank``: :func:`pairs` as part ``pair`` and :func:`typical_terms` as part ``term``,
    ranked by value and item; see :func:`count` for null, repeated and empty rows. All arithmetic is on whole numbers."""
    audit = count(docs, least_docs, text_col, lang_col, source_col)
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    between = pairs(audit).withColumn("rank", rank).withColumn("part", F.lit("pair"))
    return between.select(*columns).unionByName(typical_terms(audit, most).withColumn("part", F.lit("term")).select(*columns))
