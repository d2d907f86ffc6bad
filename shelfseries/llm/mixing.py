"""Mixing sources to target weights: complete epochs, then an Efraimidis-Spirakis sample of the rest.

Every source gets a budget of words. A source takes all its documents as often as the budget holds it whole; what is left
of the budget goes to its documents in the order of exponential keys ``-ln(u) / quality``, which is the order of weighted
sampling without replacement. Sizes are summed up along that order over all partitions, so a source may hold any share of
the rows; the document at the end of the budget gives its first words only.
"""

from __future__ import annotations

import re
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import hold, positions

#: A word; fixed value.
WORD = r"[^\x20\x09-\x0D]+"
#: Bits of the hash that becomes a uniform number.
_BITS = 48
_WIDE = "decimal(38,0)"
SMALLEST = 1e-300


def words_in(text: Column) -> Column:
    """Number of words of a text, null as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exponential_key(seed: str, ident: Column, quality: Column) -> Column:
    """``-ln(u) / quality`` with ``u`` in (0, 1) from a hash of the seed and the id, null as empty: smallest first, an order
    of sampling without replacement with probabilities proportional to ``quality`` (above 0)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("")))
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("double")
    return -F.ln((number + 0.5) / F.lit(float(1 << _BITS))) / quality


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """``source, place, weight, source_size, target, budget, epochs, rest`` for the rows ``source, source_size``.

    Sources in code point order, null last, get the ``weights`` in turn and share the total of all sizes by weight; none gets
    over ``most`` times its size, and what it cannot take goes to the others by weight, until nobody is above. The
    budget is the target's whole words: ``epochs`` times the source and ``rest``. A round over the table settles every
    source that is above; only sums come to the driver, all of them exact.
    """
    placed = positions(sources.withColumn("missing", F.col("source").isNull()), ["missing", "source"], "mix-sources", partitions=1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    table = placed.select("source", F.col("position").alias("place"), weight.cast("long").alias("weight"), "source_size")
    cap = F.col("source_size").cast(_WIDE) * most
    share = F.col("weight").cast(_WIDE)
    full = F.lit(False)
    money, heads = table.agg(F.sum("source_size").cast(_WIDE), F.sum(share)).first()
    left, open_weight, settled = int(money or 0), int(heads or 0), -1
    total = left
    while open_weight and left >= 0:
        # above: cap < left * weight / open_weight; shares of the others only grow, so who is settled stays so
        full = cap * F.lit(open_weight).cast(_WIDE) <= share * F.lit(left).cast(_WIDE)
        count, capped, gone = table.where(full).agg(F.count(F.lit(1)), F.sum(cap), F.sum(share)).first()
        if count == settled:
            break
        settled = count
        left, open_weight = total - int(capped or 0), int(heads) - int(gone or 0)
    if not open_weight:
        full = F.lit(True)
    part = share * F.lit(left).cast(_WIDE)
    budget = F.when(full, cap.cast("long")).otherwise(F.expr(f"({_sql(left)} * cast(weight as {_WIDE})) div {_sql(max(open_weight, 1))}"))
    exact = F.when(full, cap.cast("double")).otherwise(part.cast("double") / F.lit(float(max(open_weight, 1))))
    size = F.greatest("source_size", F.lit(1))
    return table.withColumns({"target": exact, "budget": budget.cast("long")}).withColumns({
        "epochs": F.floor(F.expr("budget div greatest(source_size, 1L)")).cast("long"), "rest": F.col("budget") % size})


def _sql(n: int) -> str:
    return f"cast({n} as {_WIDE})"


def mix(
    docs: DataFrame, quality: Column | None = None, ratings: DataFrame | None = None, weights: tuple[int, ...] = (1, 2, 3),
    most: int = 3, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """What the mix takes of every row: ``id, source, size, source_size, target, epochs, taken`` (see :func:`targets`).

    ``taken`` counts words with repeats: ``epochs`` whole passes, and the size, a part or nothing more from the sample. The
    taken words of a source add up to its target's whole part, and no row gives more than ``most`` times its size.
    ``quality`` is an expression over the columns of ``docs``, 1 without it; where ``ratings`` (``id, quality``, the largest
    counts where an id repeats) has the row's id, that quality holds. Null, 0 or less count as ``SMALLEST``.
    ``carry`` names columns that come along in a struct ``carried``.

    Null texts and texts without words have size 0 and give nothing; a null source is a source of its own, apart from the
    empty one; rows with the same id, or without one, share a key and stand side by side, smaller sizes first; rows that
    repeat are sampled each on its own. Other columns are not read. An empty table gives no rows. Runs agree with each
    other as long as the rows do.
    """
    own = F.lit(1.0) if quality is None else quality.cast("double")
    ident = F.col(f"`{id_col}`")
    rows = docs.select(
        ident.alias("id"), F.col(f"`{source_col}`").alias("source"), words_in(F.col(f"`{text_col}`")).alias("size"),
        own.alias("quality"),
        *[F.struct(*[F.col(f"`{c}`") for c in carry]).alias("carried")] * bool(carry))
    rows = hold(rows, "mix-sizes")  # texts are read once
    if ratings is not None:
        rated = ratings.groupBy(F.col("id").alias("rated")).agg(F.max("quality").cast("double").alias("rating"))
        known = F.when(F.col("rated").isNotNull(), F.col("rating")).otherwise(F.col("quality"))
        rows = rows.join(rated, F.col("id") == F.col("rated"), "left").withColumn("quality", known).drop("rated", "rating")
    good = F.greatest(F.coalesce("quality", F.lit(0.0)), F.lit(SMALLEST))
    rows = rows.withColumn("key", exponential_key(seed, F.col("id"), good)).drop("quality")
    plan = hold(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-targets")
    keyed = rows.join(plan.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of", "weight", "budget")
    spread = positions(keyed, ["place", "key", "id", "size"], "mix-order", F.col("size"))
    # words of all sources before this one; one row per source
    before = {0: 0}
    for r in sorted(plan.select("place", "source_size").collect(), key=lambda r: r["place"]):
        before[r["place"] + 1] = before[r["place"]] + r["source_size"]
    start = F.element_at(F.create_map(*[F.lit(x).cast("long") for pair in before.items() for x in pair]), F.col("place"))
    sampled = F.greatest(F.least(F.col("rest") - (F.col("position") - start), F.col("size")), F.lit(0))
    return spread.select(
        "id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + sampled).alias("taken"),
        *["carried"] * bool(carry))


def _first_words(batches):
    """Texts up to the end of their word number ``words``."""
    word = re.compile(WORD.encode())
    for b in batches:
        ends = (next(islice(word.finditer(t), n - 1, None)).end() for t, n in zip(b.column("body").to_pylist(), b.column("words").to_pylist()))
        cut = pa.array([t[:end].decode() for t, end in zip(b.column("body").to_pylist(), ends)], pa.string())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], cut], names=[*b.schema.names[:-1], "text"])


def corpus(mixed: DataFrame) -> DataFrame:
    """The mixed corpus from :func:`mix` with a carried column ``text``: a row per document and epoch with ``id, source,
    epoch, words, text``, the text cut behind its last word that is taken. Rows of which nothing is taken are left out."""
    words = F.least(F.col("size"), F.col("taken") - F.col("epoch") * F.col("size"))
    passes = F.sequence(F.lit(0), F.ceil(F.col("taken") / F.col("size")).cast("int") - 1)
    rows = mixed.where("taken > 0").withColumn("epoch", F.explode(passes)).withColumn("words", words)
    whole = rows.where(F.col("words") == F.col("size")).select("id", "source", "epoch", "words", F.col("carried.text").alias("text"))
    part = rows.where(F.col("words") < F.col("size")).select(  # one for each source
        "id", "source", "epoch", "words", F.col("carried.text").cast("binary").alias("body"))
    return whole.unionByName(part.mapInArrow(_first_words, whole.schema))
