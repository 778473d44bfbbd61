"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[Column | str], newest_first: Sequence[Column]
) -> DataFrame:
    """The first row of every key in the given order.

    Spark turns `row_number() = 1` into a group limit that runs before the shuffle,
    so at most one row per key leaves each task, however many a key has.
    """
    order = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")
    )
