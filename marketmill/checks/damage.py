"""Models with rows that break each of their data tests, in Spark and as SQL.

For every test of a model, half of its rows, by their hashed key, are added once more with
the tested column changed so that the test fails: the lower half for every second test, the
upper half for the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.checks.sql import TABLES
from marketmill.operators import quality
from marketmill.plans.quality_suite import NOT_NULL, tests_of

MIDDLE = "8"  # of hex digits
PREFIX = "damaged_"
WHOLE_NUMBERS = {("stg_orders", "customer_id"), ("stg_olist_order_reviews", "review_score")}


def broken(test: quality.Test) -> tuple[str, str]:
    """A column and the value, as SQL of both engines, that breaks the test."""
    column = test.column
    whole = (test.model, column) in WHOLE_NUMBERS
    if isinstance(test, quality.NotNull):
        return column, "NULL"
    if isinstance(test, quality.Unique):
        return column, column
    if isinstance(test, quality.AcceptedValues):
        return column, "9" if whole else "'unheard of'"
    if isinstance(test, quality.Relationship):
        return column, "-999999999" if whole else "'nobody'"
    if isinstance(test, quality.ExpressionIsTrue):
        return column, "'no address'" if "like" in test.condition else "-1"
    counted = test.condition.split(" ", 1)[0]
    return counted, "total_orders + 1"


def damaged(model: str, df: DataFrame) -> DataFrame:
    """`df`, read once, with the rows that break its tests."""
    hashed = F.md5(F.col(NOT_NULL[model][0]).cast("string").cast("binary"))
    tests = tests_of(model)
    # The key is hashed once a row, not once a test.
    halved = df.withColumn("_lower", hashed < MIDDLE)
    lower, upper = (F.array(F.lit(-1), *map(F.lit, range(i, len(tests), 2))) for i in range(2))
    chosen = F.when(F.col("_lower"), lower).when(~F.col("_lower"), upper)
    copies = halved.withColumn("_broken", F.explode(F.coalesce(chosen, F.array(F.lit(-1)))))
    columns = {field.name: F.col(field.name) for field in df.schema}
    kinds = {field.name: field.dataType for field in df.schema}
    for i, test in enumerate(tests):
        column, value = broken(test)
        now = F.when(F.col("_broken") == i, F.expr(value).cast(kinds[column]))
        columns[column] = now.otherwise(columns[column])
    return copies.select(*(value.alias(name) for name, value in columns.items()))


def damaged_sql(model: str) -> str:
    parts = [f"SELECT * FROM {model}"]
    for i, test in enumerate(tests_of(model)):
        column, value = broken(test)
        parts.append(
            f"SELECT * REPLACE ({value} AS {column}) FROM {model} "
            f"WHERE md5(CAST({NOT_NULL[model][0]} AS VARCHAR)) {('<', '>=')[i % 2]} '{MIDDLE}'"
        )
    return " UNION ALL ".join(parts)


TABLES.update({PREFIX + model: damaged_sql(model) for model in NOT_NULL})
