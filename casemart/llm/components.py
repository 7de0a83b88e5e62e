"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casemart.llm.storage import Scratch


def _smallest_neighbour(edges: DataFrame) -> DataFrame:
    """Both directions of each edge, with the smallest node of the neighbourhood of `u` (u included)."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("near")).select("u", F.least("u", "near").alias("least"))
    return both.join(least, "u")


def components(edges: DataFrame, scratch: Scratch, name: str = "component") -> DataFrame:
    """(node, component): each node with an edge and the smallest node it can reach.

    `edges` holds `u` and `v` of any orderable type. Every round sends larger neighbours to the smallest one (large star), then
    smaller neighbours among themselves (small star); the number of rounds grows with the logarithm of the longest path. Rounds
    are stored, only their checksum comes to the driver, and minima are combined before the shuffle.
    """
    now = scratch.store(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), f"{name}-0")
    last, step = None, 0
    while True:
        mark = now.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == last or not mark["n"]:
            break
        last, step = mark, step + 1
        large = _smallest_neighbour(now).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        large = scratch.store(large.where("u <> v"), f"{name}-large-{step}")
        lower = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = lower.groupBy("u").agg(F.min("v").alias("least"))
        small = lower.join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).unionAll(
            least.select("u", F.col("least").alias("v")))
        now = scratch.store(small.where("u <> v").distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-large-{step}", f"{name}-{step - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(now.select("v", "v").distinct())


def merged_components(label: DataFrame, edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """`label`, as `components` gives it, after more edges: only edges between known components are contracted, and the result is stored."""
    of_u, of_v = (label.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")) for end in ("u", "v"))
    between = edges.join(of_u, "u", "left").join(of_v, "v", "left").select(F.coalesce("of_u", "u").alias("u"), F.coalesce("of_v", "v").alias("v"))
    found = components(between, scratch, name)
    moved = label.join(found.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    new = found.join(label.select("node"), "node", "left_anti")
    return scratch.store(moved.select("node", F.coalesce("to", "component").alias("component")).unionAll(new.select("node", "component")), f"{name}-all")
