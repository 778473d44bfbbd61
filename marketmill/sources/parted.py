"""Tables in parts, of which an update writes only those it touches.

A part is one or more folders. A manifest, a small table of the warehouse, names them, and
pointing its name at a new manifest publishes all parts of an update together. Folders that
a manifest names are never written again, so a reader goes on with those it has seen and a
job that dies half-way leaves the old table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from marketmill.operators.upsert import upsert
from marketmill.sources.tables import Warehouse, shape

MANIFEST = "part int, location string, rows bigint, highest bigint, note string"
PART = "_part"
BUCKETS = 256


@dataclass(frozen=True)
class Folder:
    """One folder of a part: its rows and their highest id. `note` is the owner's."""

    part: int
    location: str | None
    rows: int
    highest: int | None = None
    note: str | None = None


class PartedTable:
    """`namespace`.`table` with the columns of `schema`, in numbered parts.

    The driver sees one manifest row for each folder. `id_column` is a whole number.
    """

    def __init__(
        self, warehouse: Warehouse, namespace: str, table: str, schema: StructType, id_column: str = "id"
    ) -> None:
        self.warehouse = warehouse
        self.namespace = namespace
        self.table = table
        self.schema = schema
        self.id_column = id_column

    @property
    def manifest(self) -> str:
        return f"{self.table}_parts"

    def exists(self) -> bool:
        return self.warehouse.exists(self.namespace, self.manifest)

    def folders(self) -> list[Folder]:
        if not self.exists():
            return []
        rows = self.warehouse.read(self.namespace, self.manifest).collect()
        return sorted((Folder(*row) for row in rows), key=lambda f: (f.part, f.location or ""))

    def read(self, parts: Iterable[int] | None = None) -> DataFrame:
        """All rows, or those of some parts; other folders are not opened."""
        return self.read_folders(self.folders(), parts)

    def read_folders(self, folders: list[Folder], parts: Iterable[int] | None = None) -> DataFrame:
        wanted = None if parts is None else set(parts)
        paths = [
            f"{f.location}/{PART}={f.part}"
            for f in folders
            if f.rows and (wanted is None or f.part in wanted)
        ]
        spark = self.warehouse.spark
        if not paths:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*paths)

    def stage(self, df: DataFrame, part: Column) -> list[Folder]:
        """Write rows to new folders, one for each part; a large part is many files."""
        if shape(df.schema) != shape(self.schema):
            raise ValueError(f"{self.table} has columns {shape(self.schema)}, not {shape(df.schema)}")
        spark = self.warehouse.spark
        location = f"{self.warehouse.root}/{self.namespace}/{self.table}/{uuid.uuid4().hex}"
        dealt = df.withColumn(PART, part.cast("int")).hint("rebalance", PART)
        dealt.write.partitionBy(PART).parquet(location)
        schema = StructType([*self.schema.fields]).add(PART, IntegerType())
        written = spark.read.schema(schema).parquet(location).groupBy(PART)
        counts = written.agg(F.count(F.lit(1)), F.max(F.col(self.id_column).cast("bigint"))).collect()
        return [Folder(number, location, rows, highest) for number, rows, highest in counts]

    def publish(self, folders: list[Folder]) -> None:
        """The manifest of the table from now on, in one step."""
        rows = [(f.part, f.location, f.rows, f.highest, f.note) for f in folders]
        manifest = self.warehouse.spark.createDataFrame(rows, MANIFEST).coalesce(1)
        self.warehouse.replace(manifest, self.namespace, self.manifest)


class KeyedTable:
    """A table of unique keys in hash buckets; an upsert rewrites the buckets it touches.

    `keys` names the key expressions, as for `upsert`. The number of buckets is that of the
    first write.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        namespace: str,
        table: str,
        schema: StructType,
        keys: Mapping[str, Column],
        id_column: str = "id",
        buckets: int = BUCKETS,
    ) -> None:
        self.parts = PartedTable(warehouse, namespace, table, schema, id_column)
        self.keys = keys
        self.buckets = buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys.values()), F.lit(self.buckets)).cast("int")

    def known(self) -> list[Folder]:
        folders = self.parts.folders()
        for folder in folders:
            if folder.note != str(self.buckets):
                raise ValueError(f"{self.parts.table} has {folder.note} buckets, not {self.buckets}")
        return folders

    def marked(self, folders: list[Folder]) -> list[Folder]:
        return [Folder(f.part, f.location, f.rows, f.highest, str(self.buckets)) for f in folders]

    def read(self) -> DataFrame:
        return self.parts.read_folders(self.known())

    def replace(self, df: DataFrame) -> None:
        """The whole table anew."""
        self.parts.publish(self.marked(self.parts.stage(df.select(*self.parts.schema.names), self.bucket())))

    def upsert(
        self, batch: DataFrame, updated: Sequence[str], newest_first: Sequence[Column]
    ) -> set[int]:
        """Insert, or update where the key exists, as `upsert` does; the buckets rewritten.

        Of the table only the buckets of the batch's keys are read. New ids go on from the
        highest one, which the manifest knows.
        """
        folders = self.known()
        touched = {row[0] for row in batch.select(self.bucket()).distinct().collect()}
        if not touched:
            return touched
        highest = max((f.highest for f in folders if f.highest is not None), default=0)
        changed = upsert(
            self.parts.read_folders(folders, touched),
            batch,
            self.keys,
            updated,
            self.parts.id_column,
            newest_first,
            highest=F.lit(highest),
        )
        staged = self.marked(self.parts.stage(changed, self.bucket()))
        self.parts.publish([f for f in folders if f.part not in touched] + staged)
        return touched
