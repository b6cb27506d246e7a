"""Connected components of links that are never brought together in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankfield.session import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Point every node's larger (or other) neighbours at the least node it sees."""
    if large:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    least = seen.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    met = seen.join(least, F.col("u") == F.col("c"))
    moved = met.filter(F.col("v") > F.col("u")) if large else met
    out = moved.select(F.col("m").alias("u"), "v")
    if not large:
        out = out.unionByName(least.select(F.col("m").alias("u"), F.col("c").alias("v")))
    return out.filter("u < v").distinct()


def components(links: DataFrame) -> DataFrame:
    """Return ``node`` and ``component``, the least node it reaches, for every linked node.

    ``links`` has whole numbers ``u`` and ``v``; direction, repeats, self-links and nulls do
    not matter. Large-star and small-star steps take turns until nothing changes; each step is
    written, so losing an executor never repeats earlier ones.
    """
    ends = links.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    edges = written(ends.filter("u < v").select("u", "v").distinct(), "links")
    state = None
    while True:
        # Equal counts and hashes before and after a step mean the same links.
        now = edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if now == state or now[0] == 0:
            break
        state = now
        edges = written(_star(_star(edges, large=True), large=False), "links")
    stars = edges.select(F.col("v").alias("node"), F.col("u").alias("component"))
    roots = edges.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return stars.unionByName(roots)
