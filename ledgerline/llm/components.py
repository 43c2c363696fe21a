"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import materialize


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def _oriented(a, b) -> list:
    return [F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")]


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b) that is not the smallest
    of its component.

    Each round replaces the edges, first of every node to its larger neighbours, then to
    its smaller ones, by edges to the least node around it; the rounds end when the edges
    stay the same, which takes a number of rounds about logarithmic in the longest path.
    Minima are pre-aggregated, and a node with very many edges is only ever the probed
    side of an equi-join with one row per key, which Spark can split.  Each round is
    written to the shared folder.  Self-loops and repeated edges do no harm; an empty
    edge table gives an empty result.
    """
    now = materialize(spark, edges.where("a <> b").select(*_oriented(F.col("a"), F.col("b"))).distinct(), "edges")
    before = _signature(now)
    while before[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")) \
            .unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = materialize(spark, large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").select(F.explode(F.array(
            F.struct(F.col("hi"), F.col("m").alias("lo")),
            F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")) \
            .select("e.hi", "e.lo").where("hi <> lo").distinct()
        now = materialize(spark, small, "small-star")
        after = _signature(now)
        if after == before:
            break
        before = after
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
