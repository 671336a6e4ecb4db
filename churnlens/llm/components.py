"""Connected components of an undirected edge table, by contraction rounds.

Each round every vertex points at the smallest vertex among itself and its
neighbours. Pointers only fall, so they form trees; they are doubled until every vertex points at
its root (a chain of n pointers takes log2(n) doublings), and edges are rewritten to the
roots of their ends; edges inside one tree disappear. Only vertices smaller than all their
neighbours stay roots, so a chain in any order of ids ends after a few rounds. Every step writes
its tables to shared storage (no growing lineage, nothing on the driver but whether
rows are left). Hub vertices cost nothing extra: minima are pre-aggregated before
the shuffle, and joins go against tables with one row per vertex, which AQE can
split on the skewed side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.common import save


def _roots(pointers: DataFrame) -> DataFrame:
    """Pointers doubled until they all point at roots."""
    while True:
        nxt = pointers.select(F.col("v").alias("p"), F.col("p").alias("q"))
        doubled = save(pointers.join(nxt, "p").select("v", F.col("q").alias("p"),
                                                      (F.col("q") != F.col("p")).alias("moved")),
                       "pointers")
        pointers = doubled.select("v", "p")
        if doubled.where("moved").isEmpty():
            return pointers


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(v, component): the smallest vertex reachable from each vertex with an edge
    to another one. Vertices of no such edge are absent. NULL ends are ignored."""
    left = save(edges.where(F.col(a) != F.col(b)).select(
        F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct(), "edges")
    found = None
    while not left.isEmpty():
        both = left.select(F.col("y").alias("v"), F.col("x").alias("p")).unionByName(
            left.select(F.col("x").alias("v"), F.col("x").alias("p")))
        pointers = save(both.groupBy("v").agg(F.min("p").alias("p")), "pointers")
        pointers = _roots(pointers)
        if found is None:
            found = pointers.select("v", F.col("p").alias("component"))
        else:
            nxt = pointers.select(F.col("v").alias("component"), F.col("p").alias("_q"))
            found = found.join(nxt, "component", "left").select(
                "v", F.coalesce("_q", "component").alias("component"))
        found = save(found, "components")
        ends_x = pointers.select(F.col("v").alias("x"), F.col("p").alias("_x"))
        ends_y = pointers.select(F.col("v").alias("y"), F.col("p").alias("_y"))
        left = save(left.join(ends_x, "x").join(ends_y, "y")
                    .where(F.col("_x") != F.col("_y"))
                    .select(F.least("_x", "_y").alias("x"), F.greatest("_x", "_y").alias("y"))
                    .distinct(), "edges")
    if found is None:
        return left.select(F.col("x").alias("v"), F.col("y").alias("component"))
    return found
