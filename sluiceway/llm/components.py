"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import cut, drop_cut


def _sum(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for each node in ``links`` (a, b of type long): the smallest node that can be reached.

    Alternating large and small stars (Kiveris et al., 2014): each round hangs neighbours onto the smallest node nearby,
    until only stars are left, in a number of rounds logarithmic in the number of nodes. Each round is joins and
    aggregates on single nodes; a node with very many neighbours is never gathered in one place, and Spark can split its
    join. Rounds are written out, so none is ever computed again, and
    deleted when the next one is written. Loops and repeated links are fine; without links
    there are no rows.
    """
    plain = links.select("a", "b").filter("a <> b")
    edges = cut(plain.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before, start = _sum(edges), edges
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written out, so that what is left is a plain join of two shuffles, which Spark can split where a node is hot.
        least = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")), label)
        large = both.filter("b > a").join(least, F.col("a") == F.col("k")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = cut(large, label)
        lower = cut(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m"), label)
        hung = large.join(lower, F.col("a") == F.col("k")).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(lower.select(F.col("k").alias("a"), F.col("m").alias("b")).unionByName(hung).distinct(), label)
        drop_cut(start, least, large, lower)
        now, start = _sum(edges), edges
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
