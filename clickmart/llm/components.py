"""Connected components of a large edge list, as joins and aggregates.

Rounds of large-star and small-star steps: each node points all its larger neighbours, then
all its smaller ones, at the smallest node it sees. The edge list ends as stars around the
smallest node of each component, after a number of rounds in the order of the logarithm of
the longest chain. Each round is written to the shared folder; a hub's neighbours are never
gathered in one row (minimum by partial aggregate, joined back)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart.llm.common import stored
from clickmart.session import clear_scratch, scratch_mark


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u > v)."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = near.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = near.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select("v", "m").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (two columns u, v of one type) but the roots
    themselves; root is the smallest node of the component. Loops, repeats and both
    directions of an edge are allowed; no edges give no rows."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    spark, mark = edges.sparkSession, scratch_mark(edges.sparkSession)
    edges = stored(edges, "llm-edges")
    last = _fingerprint(edges)
    while last[0]:
        edges = stored(_star(_star(edges, large=True), large=False), "llm-edges")
        clear_scratch(spark, mark, keep_last=True)  # the round before
        now = _fingerprint(edges)
        if now == last:
            break
        last = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
