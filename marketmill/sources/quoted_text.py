"""CSV records whose quoted cells hold line breaks, read in byte ranges by many tasks.

Spark reads the lines of a range, and a range may begin inside a quoted cell. A first pass
therefore follows every range from both beginnings, outside and inside of quotes, and tells
where each of them ends. From these few numbers the state at the start of each range
follows, and the range in which a record that crosses ranges begins. The second pass reads
the ranges anew, each from its known state: records that lie in one range are whole, and
the pieces of the others, at most two a range, meet by the range they begin in. A task takes
several ranges where they are small.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

QUOTE, COMMA, MARK = '"', ",", "﻿"
CLOSING = re.compile(r'(?:[^"]++|"")*+"')  # from inside a quoted cell to its end
# A whole cell, and the rest of one that is open; what follows a closing quote is no quote.
REST = r'(?:[^"]|"")*"(?:[^",][^,]*)?'
CELL = rf'(?:"{REST}|[^",][^,]*|)'
OUTSIDE_TO_OUTSIDE = rf"\A(?:{CELL},)*{CELL}\z"
INSIDE_TO_OUTSIDE = rf"\A{REST}(?:,{CELL})*\z"
RANGE_BYTES = 64 * 1024**2
MOST_RANGES = 1_000_000  # whose states the driver and the tasks hold

# How records are told apart by the reader of single records.
RECORD_OPTIONS = {"mode": "FAILFAST", "multiLine": "true", "quote": QUOTE, "escape": QUOTE}

RANGE_SCHEMA = (
    "file long, start long, from_outside boolean, from_inside boolean, closes boolean, "
    "returns boolean"
)
PIECE_SCHEMA = "file long, owner long, start long, header boolean, record string"


def inside_after(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after `line`, if one was (`inside`) or not before it.

    A quote opens a cell only as its first character; what follows a closing quote belongs
    to the cell up to the next comma.
    """
    at = 0
    if not inside and QUOTE not in line:
        return False
    while True:
        if inside:
            closed = CLOSING.match(line, at)
            if closed is None:
                return True
            at, inside = closed.end(), False
        elif line.startswith(QUOTE, at):
            at, inside = at + 1, True
            continue
        comma = line.find(COMMA, at)
        if comma < 0:
            return False
        at = comma + 1


def insides_after(lines: pa.Array) -> tuple[list[bool], list[bool]]:
    """`inside_after` of each line, if no cell was open before it and if one was."""
    patterns = (OUTSIDE_TO_OUTSIDE, INSIDE_TO_OUTSIDE)
    outside, inside = (pc.invert(pc.match_substring_regex(lines, p)).to_pylist() for p in patterns)
    return outside, inside


def lines_of(spark: SparkSession, path: str, range_bytes: int) -> DataFrame:
    """file, start, value: the lines of `path`, with the range they begin in.

    The size of ranges is pinned to this relation, whatever the session's settings are when
    it is read: both passes must see the same ranges.
    """
    pinned = spark.newSession()
    pinned.conf.set("spark.sql.files.maxPartitionBytes", str(range_bytes))
    pinned.conf.set("spark.sql.files.minPartitionNum", "1")
    pinned.conf.set("spark.sql.files.openCostInBytes", "0")
    name = f"lines_{uuid.uuid4().hex}"
    pinned.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    ).createGlobalTempView(name)
    try:
        return spark.table(f"global_temp.{name}")
    finally:
        spark.catalog.dropGlobalTempView(name)


def tasks_for(spark: SparkSession, path: str) -> int:
    """Tasks that share the ranges of `path`: enough for all cores, and each reads about
    RANGE_BYTES of a large file, in however many ranges. A start of Python for each small
    range would cost more than reading it."""
    files = spark.read.format("binaryFile").load(path)
    total = files.select(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return max(2 * spark.sparkContext.defaultParallelism, math.ceil(total / RANGE_BYTES))


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """The lines of one range after the other; a range may come in several parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        files, starts = batch.column(0), batch.column(1)
        keys = pa.StructArray.from_arrays([files, starts], names=["file", "start"])
        ends = pc.run_end_encode(files).run_ends.to_pylist() + pc.run_end_encode(starts).run_ends.to_pylist()
        before = 0
        for end in sorted(set(ends)):
            key = keys[before].as_py()
            yield (key["file"], key["start"]), batch.column(2).slice(before, end - before)
            before = end


def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each range: where it ends from either beginning, whether a cell that is
    open at its beginning is closed in it, and whether a file begins whose first line ends
    in CR LF."""
    found: dict[tuple[int, int], list[bool]] = {}
    for key, lines in runs(batches):
        fresh = key not in found
        returns = not key[1] and lines[0].as_py().endswith("\r")
        state = found.setdefault(key, [False, True, False, returns])
        quoted = lines.filter(pc.match_substring(lines, QUOTE))
        if fresh and len(quoted) and not key[1]:
            first = pa.array([quoted[0].as_py().removeprefix(MARK)], quoted.type)
            quoted = pa.concat_arrays([first, quoted.slice(1)])
        for after in zip(*insides_after(quoted), strict=True):
            state[0], state[1] = after[state[0]], after[state[1]]
            # Once outside at the end of a line, the first open cell was closed.
            state[2] = state[2] or not state[1]
    columns = list(zip(*((*key, *state) for key, state in found.items()), strict=True))
    kinds = (pa.int64(), pa.int64(), *[pa.bool_()] * 4)
    arrays = [pa.array(c, k) for c, k in zip(columns or [[]] * 6, kinds, strict=True)]
    names = ["file", "start", "from_outside", "from_inside", "closes", "returns"]
    yield pa.RecordBatch.from_arrays(arrays, names=names)


def resolved(ranges: DataFrame) -> DataFrame:
    """file, start, returns, inside, ends_inside, owner: the state at both ends of each range.

    Each range maps the state before it to that after it: it keeps it, swaps it or sets it.
    The state at a place is what the last range set, swapped as often as ranges since did.
    `owner` is the range in which the record that is open at the beginning of it begins.
    """
    order = Window.partitionBy("file").orderBy("start")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    kinds = ranges.withColumns(
        {
            "swap": (F.col("from_outside") & ~F.col("from_inside")).cast("int"),
            "sets": F.col("from_outside") == F.col("from_inside"),
        }
    ).withColumn("swaps", F.sum("swap").over(upto))
    fixed = F.when(F.col("sets"), F.struct(F.col("from_outside").cast("int").alias("value"), "swaps"))
    last = kinds.withColumns(
        {
            "set": F.last(fixed, ignorenulls=True).over(before),
            "swapped": F.coalesce(F.sum("swap").over(before), F.lit(0)),
        }
    )
    value = F.coalesce("set.value", F.lit(0)) + F.col("swapped") - F.coalesce("set.swaps", F.lit(0))
    known = last.withColumn("inside", F.pmod(value, F.lit(2)) == 1)
    begins = F.when(~F.col("inside") | F.col("closes"), F.col("start"))
    return known.select(
        "file",
        "start",
        "returns",
        "inside",
        F.when(F.col("inside"), F.col("from_inside")).otherwise(F.col("from_outside")).alias("ends_inside"),
        F.last(begins, ignorenulls=True).over(before).alias("owner"),
    )


@dataclass
class Pieces:
    """The records of ranges; `owners` has the ranges that begin inside of a record.

    In files of `returns`, a line ends in CR LF, also inside of quotes; there it becomes LF.
    With `edges`, only pieces of records that cross ranges, and other ranges are skipped.
    """

    owners: dict[tuple[int, int], int]
    returns: set[int]
    edges: set[tuple[int, int]] | None = None

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, held, inside, owner, fresh = None, [], [], False, None, True

        def end_range() -> None:
            if held and self.edges is not None:
                rows.append((*key[:1], key[1] if owner is None else owner, key[1], fresh and not key[1], "\n".join(held)))
            held.clear()

        for now, lines in runs(batches):
            if now != key:
                end_range()
                key, owner, fresh = now, self.owners.get(now), True
                inside = owner is not None
            if self.edges is not None and key not in self.edges:
                continue
            returns = key[0] in self.returns
            afters = zip(*insides_after(lines), strict=True)
            for line, after in zip(lines.to_pylist(), afters, strict=True):
                marked = fresh and not held and not key[1] and line.startswith(MARK)
                line = line.removeprefix(MARK) if marked else line
                held.append(line.removesuffix("\r") if returns else line)
                inside = inside_after(line, inside) if marked else after[inside]
                if inside:
                    continue
                record = "\n".join(held)
                held.clear()
                if owner is not None:
                    if self.edges is not None:
                        rows.append((key[0], owner, key[1], False, record))
                    owner = None
                elif record and self.edges is None:
                    rows.append((key[0], None, key[1], fresh and not key[1], record))
                fresh = fresh and not record
            if len(rows) >= 4096:
                yield self.batch(rows)
                rows.clear()
        end_range()
        yield self.batch(rows)

    @staticmethod
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        names = ["file", "owner", "start", "header", "record"]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)


def quoted_records(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame | None:
    """header, record: the records of the files of `path`, `header` marking each file's first.

    None if more than MOST_RANGES ranges begin or end inside of quotes: their states would
    not fit in memory. Lines end in LF, or all lines of a file in CR LF; blank lines between
    records are no records. The first pass runs at once, the second when the result is read.
    """
    lines = lines_of(spark, path, range_bytes).coalesce(tasks_for(spark, path))
    known = resolved(lines.mapInArrow(states, RANGE_SCHEMA))
    told = known.filter("inside OR ends_inside OR returns").limit(MOST_RANGES + 1).collect()
    if len(told) > MOST_RANGES:
        return None
    returns = {r["file"] for r in told if r["returns"]}
    owners = {(r["file"], r["start"]): r["owner"] for r in told if r["inside"]}
    edges = {(r["file"], r["start"]) for r in told if r["inside"] or r["ends_inside"]}
    whole = lines.mapInArrow(Pieces(owners, returns), PIECE_SCHEMA).select("header", "record")
    if not edges:
        return whole
    pieces = lines.mapInArrow(Pieces(owners, returns, edges), PIECE_SCHEMA)
    joined = pieces.groupBy("file", "owner").agg(
        F.max("header").alias("header"),
        F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"),
    )
    record = F.array_join(F.col("parts.record"), "\n")
    return whole.unionByName(joined.select("header", record.alias("record")))


def quoted_cells(records: DataFrame, names: list[str]) -> DataFrame:
    """The records as text columns; a header with other names fails, as does a record with
    another number of cells."""
    schema = ", ".join(f"`{name}` string" for name in names)
    cells = records.select("header", F.from_csv("record", schema, RECORD_OPTIONS).alias("cells"))
    same = F.lit(True)
    for name in names:
        same = same & F.lower(F.col("cells")[name]).eqNullSafe(F.lit(name.lower()))
    wrong = F.raise_error(F.lit(f"the header of a file is not {', '.join(names)}"))
    kept = F.when(~F.col("header"), F.lit(True)).when(same, F.lit(False)).otherwise(wrong.cast("boolean"))
    return cells.filter(kept).select("cells.*")
