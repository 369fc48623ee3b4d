"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut


def _with_smallest(pairs: DataFrame) -> DataFrame:
    """Each (u, v) with m, the smallest of u and everything paired with it.

    The minima shrink in the map tasks; the join is one that adaptive execution splits for a hot u.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of ``links``: root is the smallest node reachable, itself included.

    Edges are only ever replaced by edges to a smaller end, so a round never has more edges than the one
    before plus one per node, and a group of any size ends as a star around its root. Rounds grow with the
    logarithm of the longest chain. Every round is stored in the checkpoint folder. Links with a NULL end
    are ignored; an empty input gives no rows.
    """
    edges = cut(
        links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
        .filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_smallest(both).filter((F.col("v") > F.col("u"))).select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).filter("u <> v").distinct()
        small = _with_smallest(large)
        edges = cut(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .filter("u <> v")
            .distinct()
        )
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
