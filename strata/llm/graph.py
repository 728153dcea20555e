"""Connected components of links that Spark found, without gathering them anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("src", "dst")).alias("x"),
                  F.sum(F.pmod(F.xxhash64("dst", "src"), F.lit(1 << 31))).alias("s")).first()
    return r["n"], r["x"], r["s"]


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest id that links lead to, for every id in ``links`` that
    isn't itself the smallest.

    Alternating star contraction: every node first hands its larger neighbours, then its smaller
    ones, the smallest id it knows, until each edge points at its component's smallest id. The
    number of rounds grows with the logarithm of the longest chain. Each half round is a partly
    aggregated minimum and a join of two written tables, so a node with very many links is split
    over tasks. Rounds end when the set of edges (by count and two sums of hashes) stays the same.
    """
    edges = stored(links.filter(F.col(a) != F.col(b))
                   .select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = stored(both.groupBy("src").agg(F.min("dst").alias("m")).withColumn("m", F.least("src", "m")))
        large = stored(edges.select(F.col("dst").alias("src"), F.col("src").alias("v")).join(low, "src")
                       .select(F.col("v").alias("src"), F.col("m").alias("dst")).distinct())
        low = stored(large.groupBy("src").agg(F.min("dst").alias("m")))
        pair = F.explode(F.array(F.struct(F.col("dst").alias("s"), F.col("m").alias("d")),
                                 F.struct(F.col("src").alias("s"), F.col("m").alias("d"))))
        edges = stored(large.join(low, "src").select(pair.alias("p")).select(F.col("p.s").alias("src"), F.col("p.d").alias("dst"))
                       .filter(F.col("src") != F.col("dst")).distinct())
        before, state = state, _state(edges)
        if before == state:
            break
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("component"))
