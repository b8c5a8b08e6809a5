"""Connected components of an edge table, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for each vertex of ``edges`` (u long, v long): root is the smallest vertex of its component.

    Each round points the larger neighbours of every vertex to its smallest neighbour, then
    the smaller ones likewise, until nothing changes; the number of rounds grows with the
    logarithm of the longest path. A round is written to the shared folder, which cuts the
    lineage. Loops and repeated edges are allowed; without edges the result is empty.
    """
    now = written(_distinct(edges.select("u", "v")), "edges")
    state = _state(now)
    while state[0]:
        large = _star(now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), larger=True)
        now = written(_star(large, larger=False), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    roots = now.select(F.col("u").alias("v"), F.col("v").alias("root"))
    return roots.union(roots.select(F.col("root").alias("v"), "root").distinct())


def _distinct(edges: DataFrame) -> DataFrame:
    """Edges from the larger to the smaller vertex, each once."""
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """``larger``: edges in both directions; each larger neighbour of u goes to the least of u and its neighbours.

    Else edges from larger to smaller; u and its neighbours go to the least neighbour.
    """
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u")
    if larger:
        out = joined.where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")
        )
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return _distinct(out)


def _state(edges: DataFrame) -> tuple:
    """Count and order-free checksum of the edges."""
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        ).first()
    )
