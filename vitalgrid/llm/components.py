"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import release, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b: bigint); root is the least node of its component.

    Each round hangs the larger neighbours of every node, then the smaller ones,
    under the least neighbour, until nothing changes; the number of rounds grows
    with the logarithm of the longest chain. A round is written to the shared
    folder, so lineage does not grow. Null ends and links of a node to itself are
    left out.
    """
    edges = stored(
        links.filter("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    state = _state(edges)
    while state[0]:
        # Large star: from u, every larger neighbour goes to the least of u and its neighbours.
        both = edges.union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (
            large.join(low, F.col("a") == F.col("u"))
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
            .filter("a != b")
            .distinct()
        )
        last, edges = edges, stored(small)
        release(last)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b"))).distinct()
