"""Windows that repeat across a corpus: what the two substring operators share.

A window is `window` consecutive units (words or bytes) of one text. Its anchor is the run
of `gram` units in it whose hash is least, the leftmost of equals: equal windows have equal
anchors at the same place, so only windows with one anchor need comparing. A text's windows
fall into runs with one anchor; such a run and its units are a segment.

1. Anchors are counted by hash. Those met more than once become a bitmap of fixed size.
2. Texts are read again and hand out the segments whose anchor is in the bitmap. A foreign
   anchor that shares a bit costs a segment; it is found out in the next step.
3. Equal segments become one row that counts its copies, merged before the shuffle. Each
   operator judges these rows its own way, copies as weights, within an anchor. An anchor with
   very many of them is dealt to it window by window, over all tasks.
4. What was found goes back to all occurrences and is gathered by document.

Only the segments of repeated anchors are shuffled, and each text once, to meet its finds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import LAST_ID, bytes_of, open_store, row_key, spare, stored, whole_text, written
from marketmill.llm.words import sliding_minimum

BITMAP_BITS = 27  # 16 MB, in each worker
SLICE_UNITS = 1 << 20  # windows of a text that are looked at at a time
REMEMBERED = 500_000  # digests of segments, per task
HOT_SEGMENTS = 20_000  # of one anchor: more are dealt window by window
LOW = np.uint64(0xFFFFFFFF)
SEGMENTS = (
    "key long, s1 long, s2 long, body binary, anchor long, windows long,"
    " doc_id long, row long, start long"
)
RANGES = "array<struct<first: bigint, last: bigint>>"
RANGE_LISTS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
FOUND = f"s1 long, s2 long, again {RANGES}, later {RANGES}"
WINDOW_COLUMNS = ["h1", "h2", "s1", "s2", "offset", "copies", "doc_id", "at"]


class Units:
    """How a text is cut into units. Subclasses say how; `window` and `gram` in units."""

    def __init__(self, window: int, gram: int):
        self.window = window
        self.gram = gram

    def load(self, text: bytes) -> int:
        """Takes a text up; its number of units."""
        raise NotImplementedError

    def grams(self, first: int, last: int) -> np.ndarray:
        """Hashes of the runs of `gram` units among units `first` to `last`."""
        raise NotImplementedError

    def body(self, first: int, last: int) -> bytes:
        """Units `first` to `last` as bytes."""
        raise NotImplementedError


def anchored(units: Units, count: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(key, place, first window, last window) of the anchors of a text, slice by slice."""
    reach = units.window - units.gram + 1
    for start in range(0, count - units.window + 1, SLICE_UNITS):
        end = min(start + SLICE_UNITS + units.window - 1, count)
        grams = units.grams(start, end)
        marked = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding_minimum(marked, reach) & LOW).astype(np.int64)
        cuts = np.flatnonzero(place[1:] != place[:-1]) + 1
        first = np.concatenate([[0], cuts])
        last = np.concatenate([cuts, [len(place)]]) - 1
        yield grams[place[first]].view(np.int64), place[first] + start, first + start, last + start


def anchor_keys(texts: DataFrame, units: Units) -> DataFrame:
    """`key`: a row for each anchor of the one column of `texts`."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, dtype=np.int64)]
            for text in bytes_of(batch.column(0)):
                found += [part[0] for part in anchored(units, units.load(text))]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found))], names=["key"])

    return texts.mapInArrow(keys, "key long")


def bitmap_of(keys: DataFrame) -> str:
    """Folder of a bitmap of `key`, 64 bits to a row: at most 2**27 / 64 rows."""
    place = keys.select(F.col("key").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1)).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    words = place.groupBy(F.shiftright("place", 6).cast("int").alias("word"))
    return written(words.agg(F.bit_or(bit).alias("mask")).coalesce(4), "anchor-bitmap")


class Bitmap:
    """A bitmap in the shared folder, loaded where it is used."""

    def __init__(self, folder: str):
        store, path = open_store(folder)
        table = pq.read_table(path, filesystem=store, columns=["word", "mask"])
        self.words = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
        self.words[table.column("word").to_numpy()] = table.column("mask").to_numpy()

    def has(self, keys: np.ndarray) -> np.ndarray:
        place = keys & ((1 << BITMAP_BITS) - 1)
        return (self.words[place >> 6] >> (place & 63)) & 1 == 1


def segments_of(texts: DataFrame, units: Units, folder: str) -> DataFrame:
    """The segments of (`doc_id`, `row`, `text`) whose anchor is in the bitmap.

    A task leaves out the body of a segment it has handed out before: one copy is enough.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = Bitmap(folder)
        handed: set[int] = set()  # bodies that this task has handed out already
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            ids, numbers = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc_id, number, text in zip(ids, numbers, bytes_of(batch.column(2)), strict=True):
                for keys, places, firsts, lasts in anchored(units, units.load(text)):
                    met = np.flatnonzero(bitmap.has(keys))
                    for key, place, first, last in zip(
                        *(part[met].tolist() for part in (keys, places, firsts, lasts)), strict=True
                    ):
                        body = units.body(first, last + units.window)
                        digest = xxhash.xxh3_128_intdigest(body)
                        if len(handed) >= REMEMBERED:
                            handed.clear()
                        carried = None if digest in handed else body
                        handed.add(digest)
                        rows.append((key, digest >> 64, digest & (2**64 - 1), carried, place - first,
                                     last - first + 1, doc_id, number, first))
                        size += len(carried or b"")
                        if size > 1 << 24:
                            yield segment_batch(rows)
                            rows, size = [], 0
            yield segment_batch(rows)

    return texts.mapInArrow(segments, SEGMENTS)


def segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 9
    arrays = []
    for i, column in enumerate(columns):
        if i == 3:
            arrays.append(pa.array(column, pa.binary()))
        elif i in (1, 2):
            arrays.append(pa.array(np.array(column, dtype=np.uint64).view(np.int64)))
        else:
            arrays.append(pa.array(column, pa.int64()))
    names = [part.split()[0] for part in SEGMENTS.split(", ")]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def ranges_of(offsets: np.ndarray) -> list[dict[str, int]]:
    """Sorted whole numbers as ranges."""
    if not len(offsets):
        return []
    cuts = np.flatnonzero(np.diff(offsets) > 1)
    firsts = offsets[np.concatenate([[0], cuts + 1])].tolist()
    lasts = offsets[np.concatenate([cuts, [len(offsets) - 1]])].tolist()
    return [{"first": a, "last": b} for a, b in zip(firsts, lasts, strict=True)]


def range_column(marks: np.ndarray, counts: np.ndarray) -> pa.Array:
    """For each segment the ranges of its marked windows; `counts` of windows, none empty."""
    begins = np.cumsum(counts) - counts
    opens, closes = marks.copy(), marks.copy()
    opens[1:] &= ~marks[:-1]
    opens[begins] = marks[begins]
    closes[:-1] &= ~marks[1:]
    closes[begins + counts - 1] = marks[begins + counts - 1]
    firsts, lasts = np.flatnonzero(opens), np.flatnonzero(closes)
    segment = np.searchsorted(begins, firsts, side="right") - 1
    pairs = [pa.array(at - begins[segment], pa.int64()) for at in (firsts, lasts)]
    edges = np.searchsorted(segment, np.arange(len(counts) + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(edges, pa.StructArray.from_arrays(pairs, names=["first", "last"]))


def hot_ranges(
    hot: DataFrame,
    compare: Callable[[DataFrame], DataFrame],
    cut: Callable[[bytes, int], list[bytes]],
) -> DataFrame:
    """What `compare` finds in anchors with very many segments, dealt window by window.

    `cut` gives the windows of a segment. They are counted by digest, merged before the
    shuffle, so one that most segments have is no hot group either. A window met once is
    left out, as such an anchor is; each other one is compared as a segment of its own.
    """

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(7)]
            rows = [np.empty((0, 8), dtype=np.int64)]
            for s1, s2, body, count, copies, doc_id, start in zip(*columns, strict=True):
                digests = b"".join([xxhash.xxh3_128_digest(part) for part in cut(body, count)])
                part = np.empty((count, 8), dtype=np.int64)
                part[:, :2] = np.frombuffer(digests, dtype="<i8").reshape(-1, 2)
                part[:, 2], part[:, 3], part[:, 5], part[:, 6] = s1, s2, copies, doc_id
                part[:, 4] = np.arange(count)
                part[:, 7] = start + np.arange(count)
                rows.append(part)
            every = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(every[:, i].copy()) for i in range(8)], names=WINDOW_COLUMNS
            )

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for body, count, parts in zip(*columns, strict=True):
                pieces = cut(body, count)
                rows += [{**part, "body": pieces[part["offset"]]} for part in parts]
            names = ("h1", "h2", "copies", "doc_id", "start", "body")
            kinds = [pa.binary() if name == "body" else pa.int64() for name in names]
            arrays = [pa.array([row[n] for row in rows], k) for n, k in zip(names, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=list(names))

    rows = hot.select("s1", "s2", "body", "windows", "copies", "doc_id", "start")
    schema = ", ".join(f"{name} long" for name in WINDOW_COLUMNS)
    every = stored(rows.mapInArrow(windows, schema), "hot-windows")
    met = every.groupBy("h1", "h2").agg(
        F.sum("copies").alias("copies"),
        F.min(F.struct("doc_id", F.col("at").alias("start"))).alias("before"),
        F.min(F.struct("s1", "s2", "offset")).alias("holder"),
    )
    met = stored(met.filter("copies > 1"), "hot-windows-met")
    # At most as many windows a segment as one anchor can serve.
    wanted = met.select("h1", "h2", "copies", "before.*", "holder.*").groupBy("s1", "s2").agg(
        F.collect_list(F.struct("h1", "h2", "copies", "doc_id", "start", "offset")).alias("parts")
    )
    bodies = hot.select("s1", "s2", "body", "windows").join(wanted, ["s1", "s2"])
    alone = bodies.select("body", "windows", "parts").mapInArrow(
        single, "h1 long, h2 long, copies long, doc_id long, start long, body binary"
    )
    judged = compare(
        alone.select(
            F.col("h1").alias("key"), F.col("h1").alias("s1"), F.col("h2").alias("s2"), "body",
            F.lit(0).cast("long").alias("anchor"), F.lit(1).cast("long").alias("windows"),
            "copies", "doc_id", "start",
        )
    )
    again = judged.select(F.col("s1").alias("h1"), F.col("s2").alias("h2"))
    joined = every.join(met.select("h1", "h2", "before").join(again, ["h1", "h2"]), ["h1", "h2"])
    later = F.when(F.expr("before < struct(doc_id, at)"), F.col("offset"))
    offsets = joined.groupBy("s1", "s2").agg(
        F.collect_list("offset").alias("again"), F.collect_list(later).alias("later")
    )

    def as_ranges(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            yield pa.array([ranges_of(np.sort(x.values.to_numpy())) for x in column], RANGE_LISTS)

    ranges = F.arrow_udf(as_ranges, RANGES)
    return offsets.select("s1", "s2", ranges("again").alias("again"), ranges("later").alias("later"))


def removed_units(
    docs: DataFrame,
    units: Units,
    compare: Callable[[DataFrame], DataFrame],
    cut: Callable[[bytes, int], list[bytes]],
    earlier: bool,
    id_col: str,
    text_col: str,
) -> DataFrame:
    """doc_id, row, ranges: the units of each text that repeated windows cover, by document.

    `compare` takes different segments, each with its number of `copies` and the place of the
    first (`doc_id`, `start`), and returns `FOUND`: of each segment the ranges of the windows
    met `again`, copies counted, and of those met before the segment's first copy (`later`).
    With `earlier` that first copy loses only the latter; else every copy loses what is met
    again. Rows that repeat an id and text share one list of ranges.
    """
    texts = docs.select(
        document_id(id_col).alias("doc_id"),
        row_key(text_col).alias("row"),
        whole_text(text_col).alias("text"),
    )
    keys = anchor_keys(texts.select("text"), units).groupBy("key").count().filter("count > 1")
    segments = stored(segments_of(texts, units, bitmap_of(keys.select("key"))), "segments")
    different = segments.groupBy("s1", "s2").agg(
        F.first("key").alias("key"),
        F.count(F.lit(1)).alias("copies"),
        F.min(F.struct("doc_id", "start")).alias("least"),
        F.first("body", ignorenulls=True).alias("body"),
        F.first("anchor").alias("anchor"),
        F.first("windows").alias("windows"),
    )
    different = stored(different.select("*", "least.*").drop("least"), "different-segments")
    per_key = different.groupBy("key").agg(
        F.count(F.lit(1)).alias("kinds"), F.sum("copies").alias("met")
    )
    per_key = per_key.filter("met > 1").drop("met")
    mixed = different.join(per_key, "key")
    found = compare(mixed.filter(F.col("kinds") <= HOT_SEGMENTS).drop("kinds"))
    if not per_key.filter(F.col("kinds") > HOT_SEGMENTS).isEmpty():
        hot = stored(mixed.filter(F.col("kinds") > HOT_SEGMENTS), "hot-segments")
        found = found.unionByName(hot_ranges(hot, compare, cut))
    least = different.select("s1", "s2", F.col("doc_id").alias("least_id"),
                             F.col("start").alias("least_start"))
    # Written first, so that the next join has two plain exchanges and a hot segment can be split.
    ruled = stored(found.join(least, ["s1", "s2"]), "ruled-segments")
    joined = segments.select("s1", "s2", "doc_id", "row", "start").join(ruled, ["s1", "s2"])
    ranges = F.col("again")
    if earlier:
        first = F.expr("doc_id = least_id AND start = least_start")
        ranges = F.when(first, F.col("later")).otherwise(ranges)
    each = joined.select("doc_id", "row", "start", F.explode(ranges).alias("range"))
    return each.groupBy("doc_id", "row").agg(
        F.collect_set(
            F.struct(
                (F.col("start") + F.col("range.first")).alias("first"),
                (F.col("start") + F.col("range.last") + units.window - 1).alias("last"),
            )
        ).alias("ranges")
    )


def document_id(id_col: str) -> Column:
    """The id as a whole number; a null one counts as larger than all others."""
    return F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST_ID))


def with_ranges(
    docs: DataFrame, found: DataFrame, id_col: str, text_col: str, ranges: str
) -> DataFrame:
    """`docs` with `ranges`, null where nothing was found."""
    number, row = spare(docs, "_id", "_row")
    keyed = docs.withColumns({number: document_id(id_col), row: row_key(text_col)})
    named = found.select(
        F.col("doc_id").alias(number), F.col("row").alias(row), F.col("ranges").alias(ranges)
    )
    return keyed.join(named, [number, row], "left").drop(number, row)


def covered(count: int, ranges: pa.Scalar) -> np.ndarray:
    """Which of `count` units lie in a range."""
    marks = np.zeros(count + 1, dtype=np.int64)
    if ranges.is_valid:
        pairs = ranges.values
        np.add.at(marks, pairs.field(0).to_numpy(), 1)
        np.add.at(marks, pairs.field(1).to_numpy() + 1, -1)
    return np.cumsum(marks[:count]) > 0
