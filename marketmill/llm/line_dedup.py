"""Line deduplication through a sharded minimal perfect hash.

Lines are counted by a 128-bit hash of their key, once per document, with partial counts
before the shuffle. The hashes found in enough documents are dealt to shards of bounded
size; each shard becomes a minimal perfect hash (levels of bit arrays with ranks) over one
half of the hash, a fingerprint array (the other half) and a count array. Documents are
then streamed once and probe the arrays, which their tasks load from the shared folder and
hold up to a byte limit. No line is joined, no text is shuffled. A hash that is not in the
index meets a foreign fingerprint and counts as rare.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import ShardCache, bytes_of, open_store, spare, stored, whole_text, written

SPACE_BYTES = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 500_000
HELD_BYTES = 256 * 1024**2  # of shards, per worker
BITS_PER_KEY = 2
POSITIVE = (1 << 63) - 1
HASHES = pa.schema([("place", pa.int64()), ("print", pa.int64())])
RESULT = "struct<text: string, n_lines: bigint, n_dropped: bigint>"


def line_keys(text: bytes) -> list[bytes]:
    """The keys of the lines: stripped of ASCII white space, A-Z in lower case."""
    return [line.strip(SPACE_BYTES) for line in text.lower().split(b"\n")]


def hashes(keys: list[bytes]) -> np.ndarray:
    """128 bits for each key, as two whole numbers."""
    joined = b"".join([xxhash.xxh3_128_digest(key) for key in keys])
    return np.frombuffer(joined, dtype="<i8").reshape(-1, 2)


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def mixed(values: np.ndarray, level: int) -> np.ndarray:
    """Spread 64-bit values anew for each level."""
    x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Distinct 64-bit values to 0..n-1: each level keeps the values that are alone in a bit.

    `levels` are the bit arrays, 64 bits to a word; `ranks` the set bits before each word.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks = []
        before = 0
        for words in levels:
            counts = np.bitwise_count(words).astype(np.int64)
            self.ranks.append(before + np.cumsum(counts) - counts)
            before += int(counts.sum())

    @classmethod
    def build(cls, values: np.ndarray) -> PerfectHash:
        levels = []
        left = values
        while left.size:
            words = max(1, math.ceil(left.size * BITS_PER_KEY / 64))
            place = (mixed(left, len(levels)) % np.uint64(words * 64)).astype(np.int64)
            alone = np.bincount(place, minlength=words * 64) == 1
            packed = np.packbits(alone.reshape(-1, 64), axis=1, bitorder="little")
            levels.append(packed.view(np.uint64).ravel())
            left = left[~alone[place]]
        return cls(levels)

    def index(self, values: np.ndarray) -> np.ndarray:
        """Places of the values; -1 or any place for values that were not built in."""
        found = np.full(values.size, -1, dtype=np.int64)
        open_ = np.arange(values.size)
        for level, (words, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            place = mixed(values[open_], level) % np.uint64(words.size * 64)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            low = words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            found[open_[hit]] = ranks[word[hit]] + np.bitwise_count(low)
            open_ = open_[~hit]
        return found


def build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """One shard: levels, fingerprints and counts, as bytes."""
    rows = rows.drop_duplicates(["place", "print"])
    values = rows["place"].to_numpy(np.int64).astype(np.uint64)
    # Two keys that share 64 bits: the second one is kept aside, by its whole hash.
    _, first = np.unique(values, return_index=True)
    mask = np.zeros(values.size, dtype=bool)
    mask[first] = True
    table = PerfectHash.build(values[mask])
    order = np.argsort(table.index(values[mask]))
    prints = rows["print"].to_numpy(np.int64)
    counts = rows["count"].to_numpy(np.int64)
    aside = np.column_stack([rows["place"].to_numpy(np.int64), prints, counts])[~mask]
    return pd.DataFrame(
        {
            "shard": [rows["shard"].iloc[0]],
            "sizes": [[words.size for words in table.levels]],
            "levels": [b"".join(words.tobytes() for words in table.levels)],
            "prints": [prints[mask][order].tobytes()],
            "counts": [np.minimum(counts[mask][order], 2**32 - 1).astype(np.uint32).tobytes()],
            "aside": [aside.astype(np.int64).tobytes()],
        }
    )


SHARD_SCHEMA = (
    "shard long, sizes array<long>, levels binary, prints binary, counts binary, aside binary"
)


class LineIndex:
    """Counts of lines, probed by hash."""

    def __init__(self, folder: str, shards: int, capacity: int = HELD_BYTES):
        self.store, self.path = open_store(folder)
        self.shards = shards
        self.cache = ShardCache(self.read, capacity)

    def read(self, shard: int):
        folder = f"{self.path}/shard={shard}"
        chosen = pafs.FileSelector(folder, allow_not_found=True)
        files = [f.path for f in self.store.get_file_info(chosen) if f.path.endswith(".parquet")]
        if not files:
            return None, 64
        row = pq.read_table(files[0], filesystem=self.store).to_pylist()[0]
        words = np.frombuffer(row["levels"], dtype=np.uint64)
        table = PerfectHash(np.split(words, np.cumsum(row["sizes"])[:-1]))
        prints = np.frombuffer(row["prints"], dtype=np.int64)
        counts = np.frombuffer(row["counts"], dtype=np.uint32)
        aside = np.frombuffer(row["aside"], dtype=np.int64).reshape(-1, 3)
        extra = {(int(a), int(b)): int(n) for a, b, n in aside}
        return (table, prints, counts, extra), words.nbytes * 2 + prints.nbytes + counts.nbytes

    def counts(self, lines: np.ndarray) -> np.ndarray:
        """In how many documents each line is; 0 for lines that are not in the index."""
        found = np.zeros(len(lines), dtype=np.int64)
        if not self.shards:
            return found
        values = lines[:, 0].astype(np.uint64)
        shard = (lines[:, 0] & POSITIVE) % self.shards
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for rows in np.split(order, cuts) if len(order) else []:
            held = self.cache.get(int(shard[rows[0]]))
            if held is None:
                continue
            table, prints, counts, extra = held
            place = table.index(values[rows])
            known = (place >= 0) & (prints[place] == lines[rows, 1])
            found[rows[known]] = counts[place[known]]
            for at in rows[~known] if extra else ():
                found[at] = extra.get((int(lines[at, 0]), int(lines[at, 1])), 0)
        return found


def count_lines(docs: DataFrame, text_col: str, least_characters: int) -> DataFrame:
    """place, print, count: in how many rows of `docs` each line key is."""

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[bytes] = []
            for text in bytes_of(batch.column(0)):
                keys += [k for k in set(line_keys(text)) if long_enough(k, least_characters)]
            found = hashes(keys)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], schema=HASHES
            )

    texts = docs.select(whole_text(text_col).alias("text"))
    return (
        texts.mapInArrow(lines, "place long, print long")
        .groupBy("place", "print")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def build_index(frequent: DataFrame) -> tuple[str, int]:
    """Folder of the shards and their number."""
    shards = math.ceil(frequent.count() / SHARD_KEYS)
    shard = F.expr(f"(place & {POSITIVE}) % {max(1, shards)}")
    dealt = frequent.withColumn("shard", shard).groupBy("shard")
    packed = dealt.applyInPandas(build_shard, SHARD_SCHEMA)
    return written(packed, "line-index", partition_by="shard"), shards


def drop_common_lines(
    docs: DataFrame,
    text_col: str = "text",
    min_documents: int = 10,
    least_characters: int = 1,
) -> DataFrame:
    """`docs` with `text` without its common lines, and with n_lines and n_dropped.

    A line goes, in every document, if its key has `least_characters` code points or more
    and is found in at least `min_documents` rows. The rest stays, joined by newlines; a
    null or empty text is one empty line. Rows that repeat an id count one by one. Columns
    named n_lines and n_dropped are replaced; all others are passed on.
    """
    counted = count_lines(docs, text_col, least_characters)
    frequent = stored(counted.filter(F.col("count") >= min_documents), "common-lines")
    folder, shards = build_index(frequent)

    def kept(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = LineIndex(folder, shards)
        for column in texts:
            yield kept_lines(list(bytes_of(column)), index, min_documents, least_characters)

    kept_udf = F.arrow_udf(kept, RESULT)
    held = spare(docs, "_kept")[0]
    found = docs.withColumn(held, kept_udf(whole_text(text_col)))
    return found.withColumns(
        {
            text_col: F.col(f"{held}.text"),
            "n_lines": F.col(f"{held}.n_lines"),
            "n_dropped": F.col(f"{held}.n_dropped"),
        }
    ).drop(held)


def kept_lines(
    texts: list[bytes], index: LineIndex, min_documents: int, least_characters: int
) -> pa.StructArray:
    """Text without common lines, number of lines, number of dropped lines."""
    keys = [line_keys(text) for text in texts]
    flat = [key for of_text in keys for key in of_text]
    common = index.counts(hashes(flat)) >= min_documents
    out, sizes, dropped, at = [], [], [], 0
    for text, of_text in zip(texts, keys, strict=True):
        gone = [
            common[at + i] and long_enough(key, least_characters) for i, key in enumerate(of_text)
        ]
        at += len(of_text)
        lines = text.split(b"\n")
        out.append(b"\n".join([line for line, drop in zip(lines, gone, strict=True) if not drop]))
        sizes.append(len(lines))
        dropped.append(sum(map(int, gone)))
    return pa.StructArray.from_arrays(
        [pa.array(out, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64()),
         pa.array(dropped, pa.int64())],
        names=["text", "n_lines", "n_dropped"],
    )
