"""Catalog tables that are rebuilt as a whole and switched in one step."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

T = TypeVar("T")

# Fixed value: tables built at the same time.
BUILD_THREADS = 4


def in_parallel(spark: SparkSession, jobs: Mapping[str, Callable[[], T]]) -> dict[str, T]:
    """Submit independent Spark jobs together, so small ones fill idle executors."""
    with ThreadPoolExecutor(BUILD_THREADS) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        return {name: job.result() for name, job in running.items()}


def shape(schema: StructType) -> list[tuple[str, str]]:
    """Names and types, in order."""
    return [(field.name, field.dataType.simpleString()) for field in schema]


def quoted(text: str) -> str:
    """A SQL string of `text`, whatever quotes or backslashes it has."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


@dataclass(frozen=True)
class Written:
    """Data that is complete on storage but not yet behind a table name."""

    namespace: str
    table: str
    location: str
    schema: StructType
    rows: int


class Warehouse:
    """Namespaces below one root folder.

    Every write goes to a folder of its own; the catalog entry is then pointed at
    it. Readers see the old rows or the new ones, a table can be rebuilt from
    itself, and a job that dies half-way leaves the previous rows untouched.
    `prefix` keeps several warehouses apart in one catalog.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = "") -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix

    def namespace(self, name: str) -> str:
        return f"{self.prefix}{name}"

    def identifier(self, namespace: str, table: str) -> str:
        return f"`{self.namespace(namespace)}`.`{table}`"

    def create_namespace(self, name: str) -> None:
        self.spark.sql(
            f"CREATE DATABASE IF NOT EXISTS `{self.namespace(name)}` "
            f"LOCATION {quoted(f'{self.root}/{name}')}"
        )

    def exists(self, namespace: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.identifier(namespace, table))

    def read(self, namespace: str, table: str) -> DataFrame:
        return self.spark.table(self.identifier(namespace, table))

    def location(self, namespace: str, table: str) -> str:
        """The folder that holds the rows of a table now."""
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.identifier(namespace, table)}")
        return told.where("col_name = 'Location'").select("data_type").first()[0]

    def stage(self, df: DataFrame, namespace: str, table: str) -> Written:
        """Write a complete new copy; the row count is taken during the write."""
        location = f"{self.root}/{namespace}/{table}/{uuid.uuid4().hex}"
        counted = Observation()
        df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(location)
        return Written(namespace, table, location, df.schema, counted.get["rows"])

    def publish(self, written: Written) -> int:
        """Point the table name at the new copy.

        A copy with other columns or types replaces the entry as well, not only its
        location; the rows of either copy stay where they are.
        """
        name = self.identifier(written.namespace, written.table)
        known = self.exists(written.namespace, written.table)
        if known and shape(self.spark.table(name).schema) == shape(written.schema):
            self.spark.sql(f"ALTER TABLE {name} SET LOCATION {quoted(written.location)}")
            self.spark.catalog.refreshTable(name)
        else:
            if known:
                self.spark.sql(f"DROP TABLE {name}")
            self.spark.catalog.createTable(
                name, path=written.location, source="parquet", schema=written.schema
            )
        return written.rows

    def replace(self, df: DataFrame, namespace: str, table: str) -> int:
        self.create_namespace(namespace)
        return self.publish(self.stage(df, namespace, table))

    def append(self, df: DataFrame, namespace: str, table: str) -> None:
        """Add rows to a table of the same columns; creates it on first use."""
        if not self.exists(namespace, table):
            self.replace(df, namespace, table)
            return
        there = shape(self.read(namespace, table).schema)
        if shape(df.schema) != there:
            raise ValueError(f"{namespace}.{table} has columns {there}, not {shape(df.schema)}")
        df.write.mode("append").insertInto(self.identifier(namespace, table))


def as_views(frames: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Register frames under their names; nothing is computed."""
    for name, df in frames.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
