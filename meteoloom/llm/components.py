"""Connected components of a link table, as repeated joins (no graph reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct (a, b) with a > b."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: connect neighbours (the greater ones, or the lesser ones and itself) of each node to the least of them.

    The minima are written first, so that both sides of the join are plain shuffles and a node
    with very many links can be split by adaptive execution. ``edges`` and the minima are deleted.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "star")
    joined = both.join(least, F.col("a") == F.col("n"))
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    out = materialize(_oriented(out), "star")
    discard(edges, least)
    return out


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """edges (a, b) of longs -> (node, component): the least node that links reach.

    Large-star and small-star steps alternate until nothing changes, which takes about as many
    rounds as the logarithm of the largest component. Self-links and repeated links are
    ignored; nodes without a link are absent; no edges give an empty table.
    """
    now, seen = materialize(_oriented(edges), "star"), None
    for _ in range(rounds):
        now = _star(_star(now, True), False)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return out.unionByName(out.select(F.col("component").alias("node"), "component").distinct())
