"""Named queries, most of them with the SQL a second engine runs for comparison."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.checks.inputs import Given
from marketmill.checks.sql import with_tables


@dataclass(frozen=True)
class Check:
    run: Callable[[Given], DataFrame]
    sql: str | None = None
    gaps: tuple[str, ...] = ()

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(self.run(Given(spark, sf_dir)), self.gaps)


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None, gaps: tuple[str, ...] = ()):
    """Register a query under `name`; `sql` may use the tables of `checks.sql`.

    `gaps` names whole-number columns that hold NULLs.
    """

    def register(run: Callable[[Given], DataFrame]) -> Callable[[Given], DataFrame]:
        if name in CHECKS:
            raise ValueError(f"{name} is registered twice")
        CHECKS[name] = Check(run, None if sql is None else with_tables(sql), gaps)
        return run

    return register


def comparable(df: DataFrame, gaps: tuple[str, ...] = ()) -> DataFrame:
    """Types both engines hand out alike: dates and times as text; decimals, and whole
    numbers with NULLs among them, as doubles.

    Only the output is converted. Sums are taken as decimals before that.
    """

    def shown(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType) or field.name in gaps:
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*(shown(field) for field in df.schema))


def columns_sql(table: str, plain: str = "", doubles: str = "", texts: str = "") -> str:
    """SELECT with the conversions of `comparable`."""
    parts = [*plain.split()]
    parts += [f"CAST({name} AS DOUBLE) AS {name}" for name in doubles.split()]
    parts += [f"CAST({name} AS VARCHAR) AS {name}" for name in texts.split()]
    return f"SELECT {', '.join(parts)} FROM {table}"
