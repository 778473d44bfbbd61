"""Benchmark decontamination by item-sized SimHash windows.

For every size of item, the windows of so many words of a document that share a run of
words with an item of that size get a SimHash; a window that shares none has similarity
zero and needs none. A multi-index over blocks of the items' fingerprints finds all items
within the radius: of 19 differing bits in 8 blocks, some block has 2 at most, and each
block has a table of the items by every value that near. Candidates are verified by the
exact similarity of their weighted (repeated) five-word runs.

Items are dealt to slices of bounded size; each slice is broadcast to one pass over the
documents.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import bytes_of, spare, whole_text
from marketmill.llm.words import run_hashes, word_hashes

RUN = 5
LEAST_SIMILARITY = 0.8
RADIUS = 19
BLOCKS = 8
SLICE_BYTES = 4 * 1024**2
WINDOWS = 4096  # fingerprinted at a time
HIT = "struct<item_id: bigint, start: bigint, similarity: double>"


def window_prints(runs: np.ndarray, width: int) -> np.ndarray:
    """SimHash of each window of `width` run hashes."""
    bits = np.unpackbits(runs.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(runs) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    over = 2 * (total[width:] - total[:-width]) > width
    return np.packbits(over, axis=1).view(">u8").ravel().astype(np.uint64)


def weighted_similarity(one: Counter, two: Counter) -> float:
    """Shared over all runs, repeats counted."""
    shared = sum((one & two).values())
    return shared / (one.total() + two.total() - shared)


class SizeIndex:
    """The items of one number of words."""

    def __init__(self, size: int):
        self.size = size
        self.run = min(RUN, size)
        self.width = size - self.run + 1  # runs in a window
        self.ids: list[int] = []
        self.runs: list[Counter] = []
        self.prints = np.empty(0, dtype=np.uint64)

    def add(self, item_id: int, runs: np.ndarray) -> None:
        self.ids.append(item_id)
        self.runs.append(Counter(runs.tolist()))
        self.prints = np.append(self.prints, window_prints(runs, self.width))

    def close(self) -> None:
        """near[block][value] marks the items whose block is near enough to the value."""
        values = np.arange(256, dtype=np.uint8)
        self.near = []
        for block in range(BLOCKS):
            own = ((self.prints >> np.uint64(8 * block)) & np.uint64(255)).astype(np.uint8)
            apart = np.bitwise_count(values[:, None] ^ own[None, :])
            self.near.append(apart <= RADIUS // BLOCKS)

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and items within the radius."""
        found = np.zeros((len(prints), len(self.ids)), dtype=bool)
        for block, near in enumerate(self.near):
            found |= near[((prints >> np.uint64(8 * block)) & np.uint64(255)).astype(np.intp)]
        window, item = np.nonzero(found)
        close = np.bitwise_count(prints[window] ^ self.prints[item]) <= RADIUS
        return window[close], item[close]


def lowered(text: bytes) -> np.ndarray:
    return word_hashes(text.decode().lower().encode())


class ItemIndex:
    """Finds the items of one slice in texts."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.sizes: dict[int, SizeIndex] = {}
        sizes_of = defaultdict(set)
        for item_id, text in items:
            words = lowered(text)
            if not len(words):
                continue
            index = self.sizes.setdefault(len(words), SizeIndex(len(words)))
            runs = run_hashes(words, index.run)
            index.add(item_id, runs)
            for run in runs.tolist():
                sizes_of[index.run, run].add(len(words))
        for index in self.sizes.values():
            index.close()
        self.known: dict[int, dict[int, set[int]]] = defaultdict(dict)
        for (length, run), sizes in sizes_of.items():
            self.known[length][run] = sizes
        bits = max(16, math.ceil(math.log2(16 * max(len(sizes_of), 1))))
        self.mask = np.uint64((1 << bits) - 1)
        self.flags = {}
        for length, runs in self.known.items():
            self.flags[length] = np.zeros(1 << bits, dtype=bool)
            self.flags[length][(np.array(list(runs), np.uint64) & self.mask).astype(np.intp)] = True

    def hits(self, text: bytes) -> list[tuple[int, int, float]]:
        """item id, first word of the best window, similarity; one for each item found."""
        words = lowered(text)
        best: dict[int, tuple[float, int]] = {}
        for length, known in self.known.items():
            runs = run_hashes(words, length)
            met = np.flatnonzero(self.flags[length][(runs & self.mask).astype(np.intp)])
            places = defaultdict(list)
            for place in met.tolist():
                for size in known.get(int(runs[place]), ()):
                    places[size].append(place)
            for size, found in places.items():
                self.search(self.sizes[size], runs, np.array(found), best)
        return [(item, start, score) for item, (score, start) in sorted(best.items())]

    def search(self, index: SizeIndex, runs: np.ndarray, places: np.ndarray, best: dict) -> None:
        width = min(index.width, len(runs))  # a shorter text is one window
        last = len(runs) - width
        spans = np.zeros(last + 2, dtype=np.int64)
        np.add.at(spans, np.maximum(places - width + 1, 0), 1)
        np.add.at(spans, np.minimum(places, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(spans[:-1]))
        cuts = np.flatnonzero((np.diff(starts) > 1)) + 1
        for span in np.split(starts, cuts):
            for at in range(0, len(span), WINDOWS):
                part = span[at : at + WINDOWS]
                prints = window_prints(runs[part[0] : part[-1] + width], width)
                for window, item in zip(*index.candidates(prints), strict=True):
                    start = int(part[window])
                    inside = Counter(runs[start : start + width].tolist())
                    score = weighted_similarity(inside, index.runs[item])
                    item_id = index.ids[item]
                    if score >= LEAST_SIMILARITY and score > best.get(item_id, (0, 0))[0]:
                        best[item_id] = (score, start)


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str,
                   item_text: str) -> Column:
    """The items met in each text, as an array of `HIT`."""
    items = benchmark.select(
        F.col(f"`{item_col}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").alias("text")
    ).filter("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = max(1, math.ceil(size / SLICE_BYTES))
    items = items.withColumn("slice", F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)))
    context = docs.sparkSession.sparkContext
    parts = []
    for number in range(slices):
        # One slice of the items: about SLICE_BYTES of text.
        rows = items.filter(F.col("slice") == number).select("item_id", "text").toArrow()
        held = sorted(
            zip(rows.column("item_id").to_pylist(), bytes_of(rows.column("text")), strict=True)
        )
        parts.append(_slice_hits(context.broadcast(held))(whole_text(text_col)))
    return F.concat(*parts)


def _slice_hits(held):
    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = ItemIndex(held.value)
        for column in columns:
            found = [
                [{"item_id": i, "start": at, "similarity": s} for i, at, s in index.hits(text)]
                for text in bytes_of(column)
            ]
            kind = pa.struct(
                [("item_id", pa.int64()), ("start", pa.int64()), ("similarity", pa.float64())]
            )
            yield pa.array(found, pa.list_(kind))

    return F.arrow_udf(each, f"array<{HIT}>")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """doc_id, item_id, start, similarity: a row for each benchmark item found in a text.

    Texts are lower-cased; words are runs without ASCII white space. `similarity` is the best
    of a window of as many words as the item (the whole text if it is shorter), `start` that
    window's first word; 0.8 or more is a find. Items without words, null items and null
    ids of items find nothing; null texts count as empty. Rows that repeat an item id give
    their best find under it.
    """
    hits = benchmark_hits(docs, benchmark, text_col, item_col, item_text)
    found = docs.select(F.col(f"`{id_col}`").alias("doc_id"), hits.alias("hits"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def without_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of `docs` in which no item of `benchmark` is found; columns unchanged."""
    hits = benchmark_hits(docs, benchmark, text_col, item_col, item_text)
    held = spare(docs, "_hits")[0]
    return docs.withColumn(held, hits).filter(F.size(held) == 0).drop(held)
