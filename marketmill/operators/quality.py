"""Data tests: each one is a query for failing rows and passes when it finds none."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.sources.tables import in_parallel

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class NotNull:
    model: str
    column: str

    @property
    def name(self) -> str:
        return "not_null"

    def fails(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    model: str
    column: str
    values: tuple

    @property
    def name(self) -> str:
        return "accepted_values"

    def fails(self) -> Column:
        return ~F.col(self.column).isin(*self.values)


@dataclass(frozen=True)
class ExpressionIsTrue:
    """`condition` is SQL that follows the column, such as `>= 0`."""

    model: str
    column: str
    condition: str

    @property
    def name(self) -> str:
        return "expression_is_true"

    def fails(self) -> Column:
        return ~F.expr(f"`{self.column}` {self.condition}")


@dataclass(frozen=True)
class Singular:
    """A condition over several columns of one model that no row may meet."""

    model: str
    column: str
    condition: str
    shown: tuple[str, ...]

    @property
    def name(self) -> str:
        return "singular"

    def fails(self) -> Column:
        return F.expr(self.condition)


@dataclass(frozen=True)
class Unique:
    model: str
    column: str

    @property
    def name(self) -> str:
        return "unique"


@dataclass(frozen=True)
class Relationship:
    model: str
    column: str
    parent: str
    parent_column: str

    @property
    def name(self) -> str:
        return "relationships"


RowTest = NotNull | AcceptedValues | ExpressionIsTrue | Singular
Test = RowTest | Unique | Relationship


def failing_rows(test: RowTest, df: DataFrame) -> DataFrame:
    """Rows that fail a one-row test; an unknown outcome passes."""
    rows = df.where(test.fails())
    return rows.select(*test.shown) if isinstance(test, Singular) else rows


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """(value, row count) of every value that is there more than once; NULL passes."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """(value, row count) of every non-null key without a parent.

    Child rows are counted per key before the join, so a key that fills a third of
    the child table is one row by the time it is shuffled.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias(column))
    return keys.join(known, column, "left_anti")


def one_row_per_test(totals: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """The single row (t0, t1, ...) as (model, column, test, failures)."""
    rows = [
        F.struct(
            F.lit(test.model).alias("model"),
            F.lit(test.column).alias("column"),
            F.lit(test.name).alias("test"),
            F.col(f"t{i}").cast("bigint").alias("failures"),
        )
        for i, test in enumerate(tests)
    ]
    return totals.select(F.inline(F.array(*rows)))


def row_test_report(df: DataFrame, tests: Sequence[RowTest]) -> DataFrame:
    """All one-row tests of a model from a single pass over it."""
    totals = df.agg(*(F.count_if(test.fails()).alias(f"t{i}") for i, test in enumerate(tests)))
    return one_row_per_test(totals, tests)


def key_report(
    tables: Tables, parent: str, column: str, tests: Sequence[Unique | Relationship]
) -> DataFrame:
    """All tests about one key, with the rows of its table and of every table that
    refers to it counted per key value in one go.

    A value with several rows in `parent` is a failure of its unique test; rows of a
    referring table under a value without any are failures of its relationship. The
    counts are merged per task, so hot values cost one row each, and the key's table
    is shuffled once however many tables refer to it.
    """
    sides = [(parent, column)]
    for test in tests:
        if isinstance(test, Relationship):
            sides.append((test.model, test.column))
    keys = [
        tables[model].select(F.col(name).alias("key"), F.lit(place).alias("side"))
        for place, (model, name) in enumerate(sides)
    ]
    counted = (
        reduce(DataFrame.union, keys)
        .where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(
            *(
                F.count_if(F.col("side") == place).alias(f"side{place}")
                for place in range(len(sides))
            )
        )
    )
    held = F.col("side0")
    lost = {
        side: F.sum(F.when(held == 0, F.col(f"side{place}"))) for place, side in enumerate(sides)
    }
    failures = [
        F.count_if(held > 1) if isinstance(test, Unique) else lost[test.model, test.column]
        for test in tests
    ]
    totals = counted.agg(
        *(F.coalesce(found, F.lit(0)).alias(f"t{i}") for i, found in enumerate(failures))
    )
    return one_row_per_test(totals, tests)


def quality_report(spark: SparkSession, tables: Tables, tests: Sequence[Test]) -> DataFrame:
    """(model, column, test, failures) for every test.

    One job per model for its row tests and one per key for the tests about it, some
    of them side by side. Only the counts come back, one row per test.
    """
    of_rows: dict[str, list[RowTest]] = {}
    of_keys: dict[tuple[str, str], list[Unique | Relationship]] = {}
    for test in tests:
        if isinstance(test, Unique):
            of_keys.setdefault((test.model, test.column), []).append(test)
        elif isinstance(test, Relationship):
            of_keys.setdefault((test.parent, test.parent_column), []).append(test)
        else:
            of_rows.setdefault(test.model, []).append(test)
    reports = {f"rows of {m}": row_test_report(tables[m], found) for m, found in of_rows.items()}
    for (model, column), found in of_keys.items():
        reports[f"key {model}.{column}"] = key_report(tables, model, column, found)
    rows = in_parallel(spark, {name: report.collect for name, report in reports.items()})
    schema = "model string, column string, test string, failures bigint"
    return spark.createDataFrame([row for found in rows.values() for row in found], schema)


class QualityError(AssertionError):
    """At least one data test found failing rows."""


def assert_all_pass(report: DataFrame) -> None:
    """Raise with the failing tests, of which there are at most as many as tests."""
    failed = report.where("failures > 0").orderBy("model", "column", "test").collect()
    if failed:
        lines = [f"{r['model']}.{r['column']} {r['test']}: {r['failures']}" for r in failed]
        raise QualityError(f"{len(failed)} data tests failed:\n" + "\n".join(lines))
