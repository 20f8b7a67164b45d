"""Connected components by alternating large and small stars, each step a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v), u > v. Large star: each node ties its larger neighbours to its least one; small star: its smaller ones."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    tied = both.join(least, "u")
    if large:
        tied = tied.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
    return tied.where("u > v").distinct()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, label) for each node with an edge: label is the least node that can be reached. Input columns a, b."""
    now = scratch.save(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), f"{name}-0")
    state, step = None, 0
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == state:
            break
        state, step = seen, step + 1
        now = scratch.save(_stars(_stars(now, True), False), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def extended(label: DataFrame, links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Labels after more links (a, b): components of the labels that the links tie, so that known ones are not walked again."""
    of = lambda x: label.select(F.col("node").alias(x), F.col("label").alias(f"l_{x}"))
    ends = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("l_a", "a").alias("a"), F.coalesce("l_b", "b").alias("b"))
    tied = scratch.save(components(ends.where("a <> b"), scratch, name).select(F.col("node").alias("was"), F.col("label").alias("now")), f"{name}-tied")
    moved = label.join(tied, F.col("label") == F.col("was"), "left").select("node", F.coalesce("now", "label").alias("label"))
    alone = tied.join(label.select(F.col("node").alias("was")), "was", "left_anti").select(F.col("was").alias("node"), F.col("now").alias("label"))
    return scratch.save(moved.unionAll(alone), f"{name}-all")
