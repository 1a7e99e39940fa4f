"""Connected components of an edge table, without driver-side state.

Alternates the large-star and small-star steps of Kiveris et al., "Connected
Components in MapReduce and Beyond" (2014).  Each step is one aggregate and one
equi-join on node ids; a hub only meets its neighbours as rows, never as a
collected list.  The join has one row per node on its right side, so adaptive
execution can split a hub's rows once they fill several partitions of the
advisory size; below that they are small.  Every round is written to the shared
folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwright.storage import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def _print(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set: its size and an order-free checksum."""
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(h.bitwiseAND(0xFFFFFFFF)), F.lit(0))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b of type long).

    ``component`` is the smallest node id that can be reached.  Self-loops,
    repeated edges and nulls are ignored; no edges give no rows.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = _print(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        after = materialize(_small_star(_large_star(now)), "edges")
        said = _print(after)
        now = after
        if said == seen:
            break
        seen = said
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
