"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """`node`, `component`: the smallest node reachable, for every node of `links` but the
    smallest of its component.

    `links` has whole numbers `a` and `b`. Alternating rounds link every node's larger
    neighbours, then its smaller ones, to the smallest it sees, until the links are stars.
    Links per round never exceed those before by more than the nodes. Each round is written
    to the shared folder, which cuts the lineage. A hot node's neighbours are reduced by a
    partial minimum, and its links are joined by a join that adaptive execution splits.
    """
    ordered = links.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = stored(ordered.distinct(), "links")
    seen = signature(now)
    while seen[0]:
        now = stored(star(star(now, larger=True), larger=False), "links")
        before, seen = seen, signature(now)
        if before == seen:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component"))


def signature(links: DataFrame) -> tuple:
    """Number of links and an order-free checksum of them."""
    row = links.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20)"))
    ).first()
    return tuple(row)


def star(links: DataFrame, larger: bool) -> DataFrame:
    """Links each node's larger (or not larger) neighbours to the least node it sees."""
    if larger:
        around = links.union(links.select("b", "a")).toDF("a", "b")
    else:
        around = links
    least = around.groupBy("a").agg(F.least("a", F.min("b")).alias("least"))
    near = around.join(least, "a")
    if larger:
        moved = near.filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = near.select(F.col("b").alias("a"), F.col("least").alias("b"))
        moved = moved.union(least.select("a", "least"))
    return moved.filter("a <> b").distinct()
