"""Substring deduplication by words, through a compressed FM-index per shard.

See `repeats` for how the words to compare are found. Segments that share an anchor are
dealt to one shard, shards are of bounded size. A shard numbers its words, builds an FM-index
over its segments, each weighted by its copies, and searches backwards from the end of every
window: the matching statistics say which windows are met more than once, and the suffix
range says where first. Both are handed out as intervals.
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
from marketmill.llm.fm_index import FMIndex
from marketmill.llm.repeats import FOUND, Units, covered, range_column, removed_units, with_ranges
from marketmill.llm.words import run_hashes, word_hashes

WINDOW = 20
GRAM = 6
SHARD_WORDS = 1_000_000
SEARCHED = 1 << 15  # windows at a time: their numbers stay in the cache
KEPT = "struct<text: string, n_words: bigint, n_removed: bigint>"


class Words(Units):
    """Runs of bytes without ASCII white space."""

    def load(self, text: bytes) -> int:
        self.text, self.words = text, None
        self.hashes = word_hashes(text)
        return len(self.hashes)

    def grams(self, first: int, last: int) -> np.ndarray:
        return run_hashes(self.hashes[first:last], self.gram)

    def body(self, first: int, last: int) -> bytes:
        if self.words is None:
            self.words = self.text.split()
        return b" ".join(self.words[first:last])


def word_windows(window: int):
    def cut(body: bytes, count: int) -> list[bytes]:
        words = body.split()
        return [b" ".join(words[i : i + window]) for i in range(count)]

    return cut


def shard_ranges(rows: pa.Table, window: int) -> pa.Table:
    """Of a shard's segments the windows met more than once, and those met earlier."""
    split = [body.split() for body in rows["body"].to_pylist()]
    numbers: dict[bytes, int] = {}
    coded = [[numbers.setdefault(word, len(numbers) + 1) for word in words] for words in split]
    symbols = np.concatenate([np.array([*words, 0], dtype=np.int64) for words in coded])
    sizes = np.array([len(words) + 1 for words in coded])
    begins = np.cumsum(sizes) - sizes
    counts = sizes - window
    segment = np.repeat(np.arange(len(split)), counts)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    place = begins[segment] + offset
    index = FMIndex(symbols, window, np.repeat(rows["copies"].to_numpy(), sizes))
    docs, starts = rows["doc_id"].to_numpy(), rows["start"].to_numpy()
    # Windows numbered by (document, start); those that tie have one number.
    at = starts[segment] + offset
    order = np.lexsort((at, docs[segment]))
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (docs[segment][order][1:] == docs[segment][order][:-1]) & (
        at[order][1:] == at[order][:-1]
    )
    when = np.full(len(symbols), len(order), dtype=np.int64)
    when[place[order]] = np.cumsum(~same)
    by_suffix = when[index.order]
    again, later = (np.zeros(len(segment), dtype=bool) for _ in range(2))
    for start in range(0, len(place), SEARCHED):
        part = place[start : start + SEARCHED]
        length, low, high = index.matches(symbols, part + window, window)
        whole = np.flatnonzero(length == window)
        if not len(whole):
            continue
        lows, back = np.unique(low[whole], return_inverse=True)
        highs = np.empty(len(lows), dtype=np.int64)
        highs[back] = high[whole]
        # Least number in each suffix range: reduceat over lows and highs, every other one.
        edges = np.column_stack([lows, highs]).ravel()
        padded = np.append(by_suffix, np.iinfo(np.int64).max)
        least = np.minimum.reduceat(padded, edges)[::2]
        again[start + whole] = True
        later[start + whole] = least[back] < when[part[whole]]
    found = rows.select(["s1", "s2"])
    for name, flags in (("again", again), ("later", later)):
        found = found.append_column(name, range_column(flags, counts))
    return found.filter(pc.greater(pc.list_value_length(found["again"]), 0))


def compare_in_shards(window: int):
    def compare(segments: DataFrame) -> DataFrame:
        held = stored(segments, "fm-segments")
        words = held.agg(F.sum(F.col("windows") + window)).first()[0] or 0
        shards = max(1, math.ceil(words / SHARD_WORDS))
        dealt = held.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))

        def ranges(rows: pa.Table) -> pa.Table:
            return shard_ranges(rows, window)

        needed = dealt.select("shard", "s1", "s2", "body", "copies", "doc_id", "start")
        return needed.groupBy("shard").applyInArrow(ranges, FOUND)

    return compare


def drop_repeated_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """`docs` with `text` without its repeated words, and with n_words and n_removed.

    Words are runs without ASCII white space. Each word goes that is covered by a run of
    `window` words which also starts earlier: in a document of a smaller id, or earlier in
    the same one; runs are judged on the input. What stays is joined by single spaces. Null
    texts have no words. Ids are whole numbers; a null id counts as larger than all others.
    Rows that share an id are not earlier than one another at the same place. Columns named
    n_words and n_removed are replaced.
    """
    units = Words(window, min(GRAM, window))
    found = removed_units(docs, units, compare_in_shards(window), word_windows(window),
                          True, id_col, text_col)

    def kept(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, ranges in batches:
            rows = [kept_words(text, r) for text, r in zip(bytes_of(texts), ranges, strict=True)]
            text, words, gone = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.StructArray.from_arrays(
                [pa.array(text, pa.binary()).cast(pa.string()), pa.array(words, pa.int64()),
                 pa.array(gone, pa.int64())],
                names=["text", "n_words", "n_removed"],
            )

    ranges, held = spare(docs, "_ranges", "_kept")
    joined = with_ranges(docs, found, id_col, text_col, ranges)
    cut = F.arrow_udf(kept, KEPT)(whole_text(text_col), F.col(ranges))
    return joined.withColumn(held, cut).withColumns(
        {
            text_col: F.col(f"{held}.text"),
            "n_words": F.col(f"{held}.n_words"),
            "n_removed": F.col(f"{held}.n_removed"),
        }
    ).drop(held, ranges)


def kept_words(text: bytes, ranges: pa.Scalar) -> tuple[bytes, int, int]:
    words = text.split()
    if not ranges.is_valid:
        return b" ".join(words), len(words), 0
    gone = covered(len(words), ranges)
    left = [word for word, drop in zip(words, gone.tolist(), strict=True) if not drop]
    return b" ".join(left), len(words), int(gone.sum())
