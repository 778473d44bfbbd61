"""Suffix-array deduplication by bytes.

See `repeats` for how the texts to compare are found. Segments are range-partitioned by the
bytes that lead from the anchor on, at splitters that Spark samples. A bucket sorts the
suffixes of its segments that start a window by multikey quicksort, eight bytes to a key:
sorted neighbours that agree are refined by the next key, those that are alone drop out, and
count as repeated only if their segment has copies. An anchor never straddles two buckets, so
nothing equal lies on both sides of a boundary; an anchor with more segments than a bucket
should hold is dealt window by window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import bytes_of, spare, stored, whole_text
from marketmill.llm.repeats import (
    FOUND,
    SLICE_UNITS,
    Units,
    covered,
    range_column,
    removed_units,
    with_ranges,
)
from marketmill.llm.words import FACTOR, spread

WINDOW = 200
GRAM = 48
LEAD = 16  # bytes that deal segments to buckets
BUCKET_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20  # of segments that are sorted together
KEPT = "struct<body: binary, n_bytes: bigint, n_removed: bigint, n_spans: bigint>"


class Bytes(Units):
    """Bytes of UTF-8, their grams hashed by a rolling polynomial."""

    def __init__(self, window: int, gram: int):
        super().__init__(window, gram)
        self.powers = None

    def tables(self, size: int) -> None:
        """Powers of FACTOR and of its inverse, random values for bytes."""
        if self.powers is None or len(self.powers) < size:
            back = np.uint64(pow(int(FACTOR), -1, 2**64))
            self.powers = np.cumprod(np.full(size, FACTOR, dtype=np.uint64))
            self.inverse = np.cumprod(np.full(size, back, dtype=np.uint64))
            self.values = spread(np.arange(1, 257, dtype=np.uint64) * FACTOR)

    def load(self, text: bytes) -> int:
        self.text = text
        return len(text)

    def grams(self, first: int, last: int) -> np.ndarray:
        size = last - first
        self.tables(min(max(size, 1 << 14), SLICE_UNITS + self.window))
        codes = np.frombuffer(self.text, dtype=np.uint8, count=size, offset=first)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(self.values[codes] * self.powers[:size], out=sums[1:])
        count = size - self.gram + 1
        return spread((sums[self.gram :] - sums[:count]) * self.inverse[:count])

    def body(self, first: int, last: int) -> bytes:
        return self.text[first:last]


def byte_windows(window: int):
    def cut(body: bytes, count: int) -> list[bytes]:
        return [body[i : i + window] for i in range(count)]

    return cut


def equal_suffixes(
    text: np.ndarray, places: np.ndarray, groups: np.ndarray, copies: np.ndarray, depth: int
) -> np.ndarray:
    """Which places start `depth` bytes that are met again: at another place of their group,
    or in a copy of their own text (`copies`, of each place).

    Multikey quicksort: places are sorted by group and key; runs that agree become the
    groups of the next key, eight bytes further on.
    """
    found = np.zeros(len(places), dtype=bool)
    active = np.arange(len(places))
    step = np.arange(8)
    for at in range(0, depth, 8):
        take = step[: min(8, depth - at)]
        chars = np.zeros((len(active), 8), dtype=np.uint8)
        chars[:, : len(take)] = text[places[active][:, None] + at + take]
        keys = chars.view(">u8").ravel().astype(np.uint64)
        order = np.lexsort((keys, groups))
        active, groups, keys = active[order], groups[order], keys[order]
        fresh = np.ones(len(active), dtype=bool)
        fresh[1:] = (groups[1:] != groups[:-1]) | (keys[1:] != keys[:-1])
        alone = fresh & np.append(fresh[1:], True)
        lone = active[alone]
        found[lone] = copies[lone] > 1
        groups = np.cumsum(fresh)[~alone]
        active = active[~alone]
        if not len(active):
            return found
    found[active] = True
    return found


def block_ranges(rows: list[tuple], window: int) -> pa.RecordBatch:
    """Ranges of the windows that are met again; whole anchors only."""
    bodies = [row[3] for row in rows]
    sizes = np.array([len(body) for body in bodies])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - window + 1
    segment = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    _, key = np.unique(np.array([row[0] for row in rows]), return_inverse=True)
    anchor = np.array([row[4] for row in rows])
    # Equal windows have their anchor at the same place.
    groups = key[segment] * (2 * window) + (anchor[segment] - offset)
    text = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    copies = np.array([row[5] for row in rows])[segment]
    flags = equal_suffixes(text, begins[segment] + offset, groups, copies, window)
    again = range_column(flags, counts)
    columns = [pa.array([row[c] for row in rows], pa.int64()) for c in (1, 2)]
    later = pa.nulls(len(rows), again.type)  # where a window is met first plays no part
    found = pa.RecordBatch.from_arrays([*columns, again, later], names=["s1", "s2", "again", "later"])
    return found.filter(pc.greater(pc.list_value_length(again), 0))


def compare_in_buckets(window: int):
    def compare(segments: DataFrame) -> DataFrame:
        lead = F.expr(f"substring(body, CAST(anchor AS INT) + 1, {LEAD})")
        held = stored(segments.withColumn("lead", lead), "suffix-segments")
        size = held.agg(F.sum(F.octet_length("body"))).first()[0] or 0
        buckets = max(1, math.ceil(size / BUCKET_BYTES))
        dealt = held.repartitionByRange(buckets, "lead", "key").sortWithinPartitions("lead", "key")

        def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            size = 0
            for batch in batches:
                columns = [batch.column(i).to_pylist() for i in range(6)]
                for row in zip(*columns, strict=True):
                    if size > BLOCK_BYTES and row[0] != rows[-1][0]:
                        yield block_ranges(rows, window)
                        rows, size = [], 0
                    rows.append(row)
                    size += len(row[3])
            if rows:
                yield block_ranges(rows, window)

        held_columns = dealt.select("key", "s1", "s2", "body", "anchor", "copies")
        return held_columns.mapInArrow(ranges, FOUND)

    return compare


def drop_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`docs` with `body` (what stays, as bytes), n_bytes, n_removed and n_spans.

    Each byte of the UTF-8 goes that is covered by a string of `window` bytes which also
    starts anywhere else, in the same document or another; strings are judged on the input
    and don't cross documents. n_spans counts the maximal removed runs. Null texts count as
    empty. Rows that repeat an id and text are documents of their own, so all of them go.
    Columns named body, n_bytes, n_removed and n_spans are replaced; the text stays as read.
    """
    units = Bytes(window, min(GRAM, window))
    found = removed_units(docs, units, compare_in_buckets(window), byte_windows(window),
                          False, id_col, text_col)

    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            rows = [kept_bytes(text, r) for text, r in zip(bytes_of(texts), ranges, strict=True)]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.StructArray.from_arrays(
                [pa.array(columns[0], pa.binary()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                names=["body", "n_bytes", "n_removed", "n_spans"],
            )

    ranges, held = spare(docs, "_ranges", "_kept")
    joined = with_ranges(docs, found, id_col, text_col, ranges)
    cut = F.arrow_udf(kept, KEPT)(whole_text(text_col), F.col(ranges))
    names = ("body", "n_bytes", "n_removed", "n_spans")
    added = {name: F.col(f"{held}.{name}") for name in names}
    return joined.withColumn(held, cut).withColumns(added).drop(held, ranges)


def kept_bytes(text: bytes, ranges: pa.Scalar) -> tuple[bytes, int, int, int]:
    if not ranges.is_valid:
        return text, len(text), 0, 0
    gone = covered(len(text), ranges)
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    left = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
    return left, len(text), int(gone.sum()), spans
