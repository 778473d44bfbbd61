"""Scratch tables and file access that the operators share."""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.session import scratch_path

SPACES = r"[\x20\x09-\x0D]+"
LAST_ID = (1 << 63) - 1  # stands for a null id while ids are compared: after all others
HELD_TEXTS = 64
NO_ID = 1 << 62  # from here on, ids stand for rows without one: ids must be smaller


def stored(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write `df` below the shared folder and read it back: cuts lineage, computes it once."""
    return df.sparkSession.read.parquet(written(df, name, partition_by))


def written(df: DataFrame, name: str, partition_by: str | None = None) -> str:
    """Write `df` below the shared folder; its path."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(path)
    return path


def whole_text(column: str) -> Column:
    """The text, a null one being empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def spare(df: DataFrame, *names: str) -> list[str]:
    """`names`, lengthened where `df` has such a column: helpers beside the caller's columns."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def row_key(text: str) -> Column:
    """Tells rows that share an id apart."""
    return F.xxhash64(whole_text(text))


def node_id(id_column: str, text: str) -> Column:
    """The id as a whole number; a row without one gets a number of its text, from NO_ID on."""
    own = row_key(text).bitwiseAND(F.lit(NO_ID - 1)) + F.lit(NO_ID)
    return F.coalesce(F.col(f"`{id_column}`").cast("long"), own)


def shown_id(node: str) -> Column:
    """A node number as an id again."""
    return F.when(F.col(node) < F.lit(NO_ID), F.col(node))


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo `divisor`."""
    return F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % divisor


def bytes_of(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes]:
    """UTF-8 bytes of a string column without nulls; a few texts are held at a time."""
    binary = column.cast(pa.large_binary())
    for start in range(0, len(binary), HELD_TEXTS):
        yield from binary.slice(start, HELD_TEXTS).to_pylist()
    del binary
    # Workers live on between stages; what a batch took goes back to the system.
    pa.default_memory_pool().release_unused()


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[str]:
    """The texts of a string column; a few are held at a time."""
    for start in range(0, len(column), HELD_TEXTS):
        yield from column.slice(start, HELD_TEXTS).to_pylist()


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a file or folder in a store that all executors reach."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


class ShardCache:
    """Shards loaded on demand; the longest unused ones go when `capacity` bytes are held."""

    def __init__(self, load: Callable[[int], tuple[object, int]], capacity: int):
        self.load = load
        self.capacity = capacity
        self.held: OrderedDict[int, tuple[object, int]] = OrderedDict()
        self.size = 0

    def get(self, shard: int) -> object:
        if shard in self.held:
            self.held.move_to_end(shard)
            return self.held[shard][0]
        value, size = self.load(shard)
        self.held[shard] = (value, size)
        self.size += size
        while self.size > self.capacity and len(self.held) > 1:
            _, (_, gone) = self.held.popitem(last=False)
            self.size -= gone
        return value
