"""Connected components of links by alternating star operations, on tables only.

Each round hangs every node's larger neighbours on its smallest one (large star), then its smaller neighbours and itself
(small star). Rounds end when the links no longer change; then every link joins a node with the smallest of its component.
Neighbour minima are partial aggregates and the joins back on hub nodes can be split by adaptive execution, so that no
node's neighbours meet in one task. Every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import saved


def _smallest(directed: DataFrame) -> DataFrame:
    """For every ``u`` the smaller of itself and its smallest ``v``."""
    return directed.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))


def _print(links: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count("*"), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node in ``links``: the smallest node that links reach, the node itself included.

    Nodes may be of any type with an order. Links with a null end and links from a node to itself join nothing; a node that
    has only such links is still returned if it isn't null.
    """
    given = saved(links.select(F.col(a).alias("a"), F.col(b).alias("b")), "links")
    nodes = given.select(F.col("a").alias("node")).union(given.select("b")).filter("node IS NOT NULL").distinct()
    stars = saved(
        given.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "stars",
    )
    seen = _print(stars)
    while seen[0]:
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).union(stars.select("b", "a"))
        large = (
            both.join(_smallest(both), F.col("u") == F.col("k"))
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = saved(large, "stars")
        small = large.join(_smallest(large), F.col("u") == F.col("k"))
        stars = saved(
            small.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
            .union(small.select("u", "m"))
            .distinct(),
            "stars",
        )
        now = _print(stars)
        if now == seen:
            break
        seen = now
    roots = stars.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component"))
