"""Connected components by alternating large-star and small-star steps.

Every step is a join and an aggregate over the links, written to the shared
folder; only two numbers per round come to the driver, observed as the links
are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lectern.llm.common import Scratch


def _smallest(sym: DataFrame) -> DataFrame:
    return sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    ends = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
    sym = edges.select(F.inline(ends))  # one scan for both directions
    out = sym.join(_smallest(sym), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return out.where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links point from the larger to the smaller number here."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    both = F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))
    return edges.join(least, "u").select(F.inline(both)).where("u <> v").distinct()


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component: the smallest node reachable) of links (a, b); nodes without links are left out."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.keep(edges, "links")
    seen = None
    while True:
        told = Observation()
        new = _small_star(_large_star(edges)).observe(told, F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"))
        new = scratch.keep(new, "star")
        scratch.drop(edges)
        edges, state = new, told.get
        if state == seen or state["n"] == 0:
            break
        seen = state
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)
