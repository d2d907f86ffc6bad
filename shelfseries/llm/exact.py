"""Exact deduplication: 128-bit content hash, smallest id kept, bytes compared inside hash groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import hold

#: A run of ASCII blanks; fixed value.
BLANKS = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with every run of ASCII blanks as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    content_hash: Callable[[Column], Column] = F.md5, fingerprint: Callable[[Column], Column] = lambda c: F.sha2(c, 256),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are byte-identical after :func:`normalised`. ``keep_id`` is the smallest id among equal
    texts. Ids that are null rank last: a group without any id has a null ``keep_id`` and keeps all its rows. Rows that
    repeat the smallest id are all marked kept; :func:`deduplicate` leaves one. An empty table gives no rows.

    The texts are shuffled once, grouped by hash and bytes with map-side combination, so a hot text travels once per
    task. Each row then finds its class by (hash, fingerprint); only where a class key has two different texts are the
    bytes joined again.
    """
    norm = normalised(F.col(f"`{text_col}`")).cast("binary")
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), norm.alias("body")).select(
        "doc_id", "body", content_hash("body").alias("h"), fingerprint("body").alias("fp"))
    grouped = hold(
        texts.groupBy("h", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .withColumn("fp", fingerprint(F.col("body")))
        .select("h", "fp", "keep_id", "group_size"), "exact-groups")
    rows, one = texts.select("doc_id", "h", "fp"), grouped
    clashing = grouped.groupBy("h", "fp").agg(F.count(F.lit(1)).alias("bodies")).where("bodies > 1").select("h", "fp")
    clash = not clashing.isEmpty()
    if clash:
        rows, one = (x.join(clashing, ["h", "fp"], "left_anti") for x in (rows, one))
    # both sides come from tables, so a hot key's rows can be split over tasks
    out = rows.join(one, ["h", "fp"]).select("doc_id", "keep_id", "group_size", F.col("fp").alias("text_sha256"))
    if clash:
        hard = texts.join(clashing, ["h", "fp"], "left_semi")
        by_bytes = hard.groupBy("h", "body").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        out = out.unionByName(hard.join(by_bytes, ["h", "body"]).select(
            "doc_id", "keep_id", "group_size", F.col("fp").alias("text_sha256")))
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose id is the smallest of their text; one row where such a row
    repeats. Rows without an id cannot be told apart and all stay. An empty table stays empty.

    What goes is decided on (id, fingerprint) alone; the documents meet that list once, as they are.
    """
    ident = F.col(f"`{id_col}`")
    rows = classes(docs, id_col, text_col).where("doc_id is not null").groupBy("doc_id", "text_sha256", "kept").agg(F.count(F.lit(1)).alias("n"))
    odd = hold(rows.where("not kept or n > 1"), "exact-decisions")
    key = (F.col("id") == F.col("doc_id")) & (F.col("fp") == F.col("text_sha256"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    marked = docs.select(whole, ident.alias("id"), F.sha2(normalised(F.col(f"`{text_col}`")).cast("binary"), 256).alias("fp"))
    stay = marked.join(odd.where("not kept").select("doc_id", "text_sha256"), key, "left_anti")
    again = odd.where("kept and n > 1").select("doc_id", "text_sha256")
    if not again.isEmpty():
        stay = stay.join(again, key, "left_anti").unionByName(stay.join(again, key, "left_semi").dropDuplicates(["id", "fp"]))
    return stay.select("doc.*")
