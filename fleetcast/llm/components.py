"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch


#: Rows of links that one task takes in a round.
TASK_ROWS = 200_000


def classes(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, label): the smallest node of its component for every node of ``links`` but the smallest.

    ``links`` has longs a and b.  Each round hangs a node's larger neighbours,
    then its smaller ones, below the smallest; it ends when every node hangs
    directly below its component's smallest.  Rows stay as many as the links;
    minima are aggregated before they meet the rows of a hub.
    """
    cur = scratch.keep(links.filter(F.col("a") != F.col("b"))
                       .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    tasks = -(-cur.count() // TASK_ROWS) or 1
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = scratch.keep(both.join(low, "u").filter(F.col("v") > F.col("u"))
                             .select(F.col("v").alias("u"), F.col("m").alias("v"))
                             .filter(F.col("u") != F.col("v")).distinct(), tasks)
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(low, "u")
        cur = scratch.keep(hung.select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                           .unionByName(low.select("u", F.col("m").alias("v")))
                           .filter(F.col("u") != F.col("v")).distinct(), tasks)
        # Done when no node hangs below two others or below one that hangs itself.
        several = cur.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        deep = cur.select(F.col("v").alias("u")).join(cur.select("u"), "u", "left_semi")
        if not several.unionByName(deep).coalesce(tasks).limit(1).count():
            return cur.select(F.col("u").alias("node"), F.col("v").alias("label"))
