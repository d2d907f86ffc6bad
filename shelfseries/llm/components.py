"""Connected components by alternating large-star and small-star steps, as joins and aggregations of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import hold

_MOST_STEPS = 100


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: larger neighbours of a node are tied to its smallest neighbour; small star: smaller ones and itself."""
    both = edges if not large else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.join(least, "u")
    if large:
        out = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v")


def components(edges: DataFrame, steps: int | None = None) -> DataFrame:
    """``edges`` has two id columns ``u, v``. Gives ``u, component`` with the smallest id reachable, for every node that
    has an edge and is not itself that smallest id. After ``steps`` steps it stops early: equal labels then still mean the
    same component, but a component may have several.

    The node with the most edges never meets all of them in one task: minima are combined before the shuffle, and the
    join beside them may be split. Every step is a written table, so a lost executor costs one step at most.
    """
    e = F.greatest("u", "v"), F.least("u", "v")
    edges = hold(edges.select(e[0].alias("u"), e[1].alias("v")).where("u <> v").distinct(), "component-edges")
    if steps is not None:
        for _ in range(steps):
            edges = hold(_star(_star(edges, True), False).distinct(), "component-edges")
        return edges.groupBy("u").agg(F.min("v").alias("component"))
    state = None
    for _ in range(_MOST_STEPS):
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state or not new[0]:
            return edges.select("u", F.col("v").alias("component"))
        state = new
        edges = hold(_star(_star(edges, True), False).distinct(), "component-edges")
    raise RuntimeError("components did not settle")
