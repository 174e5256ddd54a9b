"""Connected components of graphs that do not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.sources.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """id and component (the smallest id reachable) of every id in ``edges`` (columns a, b).

    Alternates two steps until nothing changes: every vertex connects its larger neighbours, then
    its smaller ones, to the smallest it knows. Edges stay few, rounds grow with the logarithm of
    the longest path, and each round is a table in the shared folder. Minima are aggregated ahead
    of the shuffle, and what joins them back can be split by adaptive execution, so a vertex
    with millions of neighbours is no harm.
    """
    pairs = edges.select(
        F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")
    ).filter("u <> v")
    pairs = scratch.save(f"{name}-0", pairs.distinct())
    state = _state(pairs)
    number = 0
    while state[0]:
        number += 1
        both = pairs.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(
            pairs.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m"))
        # Larger neighbours of x go to the smallest vertex around x.
        large = both.filter("y > x").join(least, "x").select(
            F.col("y").alias("v"), F.col("m").alias("u")
        )
        large = large.filter("u <> v").distinct()
        # Smaller neighbours of v, and v itself, go to the smallest of them.
        smallest = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(smallest, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
        after = small.unionByName(smallest.select("v", F.col("m").alias("u")))
        pairs = scratch.save(f"{name}-{number}", after.filter("u <> v").distinct())
        before, state = state, _state(pairs)
        if state == before:
            break
    roots = pairs.select(F.col("u").alias("id")).distinct().withColumn("component", F.col("id"))
    return pairs.select(F.col("v").alias("id"), F.col("u").alias("component")).unionByName(roots)


def _state(pairs: DataFrame) -> tuple[int, int, int]:
    """Number of edges and two sums that tell whether the edges are the same as before."""
    h = F.xxhash64("u", "v")
    row = pairs.agg(
        F.count("*"),
        F.coalesce(F.sum(F.shiftright(h, 20)), F.lit(0)),
        F.coalesce(F.sum(F.pmod(h, F.lit(2**31 - 1))), F.lit(0)),
    ).first()
    return tuple(row)
