"""Most frequent values per key, together with averages."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions.numbers import mean_of


def modes_and_means(
    df: DataFrame,
    key: str,
    modes: Sequence[str],
    means: Sequence[str] = (),
) -> DataFrame:
    """One row per `key`: the mean of each `means` column, the mode of each `modes` one.

    NULLs have no say in either; on equal counts the smallest value is the mode.
    Means are over decimals, whose sums are exact in any order.

    The built-in `mode` keeps every distinct value of a key in one task's memory.
    Here values are counted per (key, value) first - one grouping set per mode
    column, combined before the shuffle - and the winner is a minimum over those
    counts, so a key that holds a third of all rows costs no more than the others.
    """
    counted = df.groupingSets(
        [[F.col(key), F.col(column)] for column in modes], key, *modes
    ).agg(
        F.count(F.lit(1)).alias("n"),
        # 0 for the column this set is grouped by, 1 for the ones rolled away
        *(F.grouping(column).alias(f"away_{column}") for column in modes),
        *(F.sum(column).alias(f"total_{column}") for column in means),
        *(F.count(column).alias(f"seen_{column}") for column in means),
    )

    def winner(column: str) -> Column:
        candidate = F.when(
            (F.col(f"away_{column}") == 0) & F.col(column).isNotNull(),
            F.struct((-F.col("n")).alias("fewer"), F.col(column).alias("value")),
        )
        return F.min(candidate)["value"].alias(column)

    # each set covers all rows, so the means are taken from the first one only
    first = F.col(f"away_{modes[0]}") == 0

    def mean(column: str) -> Column:
        total = F.sum(F.when(first, F.col(f"total_{column}")))
        seen = F.sum(F.when(first, F.col(f"seen_{column}")))
        return mean_of(total, seen).alias(column)

    return counted.groupBy(key).agg(
        *(mean(column) for column in means),
        *(winner(column) for column in modes),
    )
