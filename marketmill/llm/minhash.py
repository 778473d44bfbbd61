"""MinHash near-duplicates by min-max hashing.

Every permutation of the shingles' hashes gives two values of a signature, the smallest and
the largest one, so half as many hashes are evaluated. Of two sets each value is equal with
a chance of their similarity, and both values of one permutation are equal a little less
often than two independent ones: estimates vary less, and bands miss no more. A band takes
the smallest (or the largest) values of a few permutations of its own.

Documents with equal sets are one class. Classes that share a band are candidates, and no
pair is handed out for all of a group: each class is first compared with the leader of the
bucket that it meets most often. Only buckets that still hold several components are
compared further, tile by tile, in numpy: inside a tile, sets already known to be connected
are not compared again, and of a bucket larger than a tile only what lies outside its
largest component meets the other tiles. All comparisons are of whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import bytes_of, node_id, row_key, shown_id, stored, whole_text
from marketmill.llm.components import components
from marketmill.llm.exact_dedup import bitmap, marked
from marketmill.llm.words import FACTOR, SPACE, run_hashes, spread, word_hashes

WORDS = 5
LEAST = 80  # percent of the union that two linked sets share
BAND_ROWS = 4
MISSED = 1e-6  # chance at most that two sets that share LEAST have no band in common
SLICE = 1 << 20  # bytes that are cut into words at a time
SHINGLE_SLICE = 512  # shingles whose permutations are evaluated at a time
TILE_SHINGLES = 500_000
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingles(text: bytes, words: int) -> np.ndarray:
    """The different shingles of a text as sorted hashes: runs of `words` words, A-Z lowered.

    A text of fewer words is one shingle, one without words has none.
    """
    found = []
    start = 0
    while start < len(text):
        stop = min(start + SLICE, len(text))
        while stop < len(text) and not SPACE[text[stop]]:
            stop += 1
        found.append(word_hashes(text[start:stop].lower()))
        start = stop
    every = np.concatenate(found) if found else np.empty(0, dtype=np.uint64)
    return np.unique(run_hashes(every, max(1, min(words, len(every)))))


def bands_for(least: int) -> int:
    """Bands, an even number: a pair that shares `least` percent misses all with MISSED at most."""
    equal = (least / 100) ** BAND_ROWS
    bands = math.ceil(math.log(MISSED) / math.log(1 - equal)) if equal < 1 else 2
    return bands + bands % 2


class MinMax:
    """Bands of the smallest and largest values under BAND_ROWS permutations each."""

    def __init__(self, bands: int):
        drawn = spread(np.arange(1, bands * BAND_ROWS + 1, dtype=np.uint64) * FACTOR)
        self.factors, self.shifts = np.split(drawn, 2)
        self.factors |= np.uint64(1)  # odd: one to one
        self.bands = bands

    def values(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The smallest and the largest value under each permutation."""
        low = np.full(len(self.factors), np.iinfo(np.uint64).max, dtype=np.uint64)
        high = np.zeros(len(self.factors), dtype=np.uint64)
        for start in range(0, len(runs), SHINGLE_SLICE):
            moved = runs[start : start + SHINGLE_SLICE, None] * self.factors + self.shifts
            np.minimum(low, moved.min(axis=0), out=low)
            np.maximum(high, moved.max(axis=0), out=high)
        return low, high

    def keys(self, runs: np.ndarray) -> np.ndarray:
        """One key for each band."""
        rows = np.concatenate(self.values(runs)).reshape(self.bands, BAND_ROWS)
        total = np.arange(self.bands, dtype=np.uint64)
        for i in range(BAND_ROWS):
            total = (total + rows[:, i]) * FACTOR
        return spread(total).view(np.int64)


def marks(text: Column, words: int, bands: int) -> Column:
    """A 128-bit hash of the set of shingles of a text, its size and its band keys."""

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        banded = MinMax(bands)
        for column in columns:
            first, second, sizes, keys = [], [], [], []
            for found in bytes_of(column):
                runs = shingles(found, words)
                digest = xxhash.xxh3_128_digest(runs.tobytes())
                first.append(int.from_bytes(digest[:8], "big", signed=True))
                second.append(int.from_bytes(digest[8:], "big", signed=True))
                sizes.append(len(runs))
                keys.append(banded.keys(runs) if len(runs) else [])
            arrays = [pa.array(x, pa.int64()) for x in (first, second, sizes)]
            arrays.append(pa.array(keys, pa.list_(pa.int64())))
            yield pa.StructArray.from_arrays(arrays, names=["s1", "s2", "size", "bands"])

    schema = "struct<s1: bigint, s2: bigint, size: bigint, bands: array<bigint>>"
    return F.arrow_udf(each, schema)(text)


def sets_of(text: Column, words: int) -> Column:
    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sets = [shingles(found, words).view(np.int64) for found in bytes_of(column)]
            yield pa.array(sets, pa.list_(pa.int64()))

    return F.arrow_udf(each, "array<bigint>")(text)


def shares(shared: np.ndarray, one: np.ndarray, two: np.ndarray, least: int) -> np.ndarray:
    """Whether `shared` is `least` percent of the union of sets of sizes `one` and `two`."""
    return 100 * shared >= least * (one + two - shared)


def fits(one: str, two: str, least: int) -> Column:
    """Whether sets of these sizes can share `least` percent."""
    return 100 * F.least(one, two) >= least * F.greatest(one, two)


def leader_links(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The rows (`node`, `leader`) of `pairs` whose sets share `least` percent, as links."""
    own = pairs.join(sets.withColumnRenamed("runs", "x"), "node")
    both = own.join(sets.toDF("leader", "y"), "leader").select("node", "leader", "x", "y")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, dtype=bool)
            for k, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                x, y = (side.values.to_numpy().view(np.uint64) for side in (x, y))
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                linked[k] = shares(np.count_nonzero(y[at] == x), len(x), len(y), least)
            kept = pa.array(linked)
            columns = [batch.column(name).filter(kept) for name in ("node", "leader")]
            yield pa.RecordBatch.from_arrays(columns, schema=LINKS)

    return both.mapInArrow(compared, "a long, b long")


def tile_links(
    x: tuple[np.ndarray, list[np.ndarray]], y: tuple[np.ndarray, list[np.ndarray]], least: int
) -> list[tuple[int, int]]:
    """Links between labels of two tiles of (labels, sets); equal labels are connected already."""
    labels, others = (np.array(side[0]) for side in (x, y))
    sizes = np.array([len(runs) for runs in y[1]])
    values = np.concatenate(y[1])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    links = []
    for i, own in enumerate(x[1]):
        open_ = others != labels[i]
        if not open_.any():
            continue
        low, high = np.searchsorted(values, own), np.searchsorted(values, own, "right")
        counts = high - low
        ends = np.cumsum(counts)
        at = np.arange(counts.sum()) + np.repeat(low - (ends - counts), counts)
        shared = np.bincount(owner[at], minlength=len(sizes))
        linked = open_ & (shared > 0) & shares(shared, len(own), sizes, least)
        for other in np.unique(others[linked]).tolist():
            mine = int(labels[i])
            links.append((mine, other))
            labels[labels == other] = mine
            others[others == other] = mine
    return links


def bucket_links(members: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links between `label`s of each bucket (`key`) that its sets of other labels show.

    `members` has key, node, label, size and largest, the label that most of a bucket has.
    A bucket of at most a tile is one tile. Of a larger one the rows of the largest label
    and the rest are in tiles of their own, and tiles of the rest are compared with all.
    """
    held = members.groupBy("key").agg(F.sum("size").alias("held"))
    split = (F.col("held") > TILE_SHINGLES) & (F.col("label") == F.col("largest"))
    dealt = members.join(held, "key").withColumn("rest", ~split)
    parts = dealt.groupBy("key", "rest").agg(
        F.ceil(F.sum("size") / TILE_SHINGLES).cast("int").alias("chunks")
    )
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = stored(
        dealt.join(parts, ["key", "rest"])
        .withColumn("chunk", chunk)
        .join(sets, "node")
        .groupBy("key", "rest", "chunk")
        .agg(F.collect_list(F.struct("label", "runs")).alias("rows")),
        "minmax-tiles",
    )
    names = tiles.select("key", F.col("rest").alias("also"), F.col("chunk").alias("j"))
    pairs = tiles.filter("rest").select("key", F.col("chunk").alias("i")).join(names, "key")
    pairs = pairs.filter("NOT also OR i < j")
    of_a = tiles.filter("rest").select("key", F.col("chunk").alias("i"), F.col("rows").alias("x"))
    of_b = tiles.select(
        "key", F.col("rest").alias("also"), F.col("chunk").alias("j"), F.col("rows").alias("y")
    )
    units = pairs.join(of_a, ["key", "i"]).join(of_b, ["key", "also", "j"]).select("x", "y")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links: list[tuple[int, int]] = []
            for x, y in zip(batch.column(0), batch.column(batch.num_columns - 1), strict=True):
                sides = [
                    (
                        side.values.field(0).to_numpy(),
                        [runs.values.to_numpy().view(np.uint64) for runs in side.values.field(1)],
                    )
                    for side in (x, y)
                ]
                links += tile_links(*sides, least)
            columns = [pa.array([link[k] for link in links], pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, schema=LINKS)

    within = tiles.filter("rest").select("rows").mapInArrow(compared, "a long, b long")
    return within.unionByName(units.mapInArrow(compared, "a long, b long"))


def open_buckets(shared: DataFrame) -> DataFrame:
    """key, largest: buckets of several labels, and the label that most of each has.

    Of buckets with the same members one is left. `shared` has key, node, label.
    """
    hashed = F.xxhash64("node")
    by_label = shared.groupBy("key", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(hashed).alias("mixed"),
        F.sum(hashed.cast("decimal(20)")).alias("total"),
    )
    by_key = by_label.groupBy("key").agg(
        F.count(F.lit(1)).alias("labels"),
        F.max(F.struct("n", "label"))["label"].alias("largest"),
        F.sum("n").alias("n"),
        F.bit_xor("mixed").alias("mixed"),
        F.sum("total").alias("total"),
    )
    several = by_key.filter("labels > 1")
    return several.groupBy("n", "mixed", "total").agg(
        F.min("key").alias("key"), F.first("largest").alias("largest")
    ).select("key", "largest")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    least: int = LEAST,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component, kept.

    A-Z are lower-cased, words are runs without ASCII white space, a document's set are its
    different shingles of `words` words (all words if there are fewer). Documents link when
    their sets share `least` percent or more of both; `component` is the smallest id
    reachable and `kept` tells the rows that have it. Null, empty and blank texts have no
    shingle and link with nothing. Ids are whole numbers below 2**62; a null id counts as
    larger than all others and is handed out as null again. Rows that share an id are
    judged one by one, and those that repeat the smallest id of a component are all kept.
    Other columns are not looked at.

    A pair that shares just `least` percent has no band in common with a chance of MISSED
    at most; every candidate is confirmed on its whole set.
    """
    found = stored(
        docs.select(
            node_id(id_col, text_col).alias("doc_id"),
            row_key(text_col).alias("row"),
            marks(whole_text(text_col), words, bands_for(least)).alias("marks"),
        ).select("doc_id", "row", "marks.*"),
        "minmax-marks",
    )
    first = found.filter("size > 0").groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "row")).alias("first"),
        F.first("size").alias("size"),
        F.first("bands").alias("bands"),
    )
    # Rows that share an id may be of several classes: nodes are numbers in the order of ids.
    classes = stored(
        first.select("s1", "s2", "size", "bands", "first.*")
        .orderBy("doc_id", "row", "s1", "s2")
        .withColumn("node", F.monotonically_increasing_id()),
        "minmax-classes",
    )
    entries = classes.select("node", "size", F.explode("bands").alias("key"))
    leaders = entries.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("node", "size")).alias("leader")
    )
    leaders = stored(leaders.filter("n > 1").select("key", "leader"), "minmax-leaders")
    shared = stored(entries.join(leaders, "key"), "minmax-buckets")

    asked = shared.select("node").distinct().join(classes.select("node", "doc_id", "row"), "node")
    sets = stored(sets_asked(docs, asked, id_col, text_col, words), "minmax-sets")

    met = shared.withColumn("led", F.col("leader.size")).withColumn("leader", F.col("leader.node"))
    met = met.filter("node <> leader").filter(fits("size", "led", least))
    most = met.groupBy("node", "leader").agg(F.count(F.lit(1)).alias("bands"))
    pairs = most.groupBy("node").agg(
        F.max(F.struct("bands", (-F.col("leader")).alias("last")))["last"].alias("last")
    )
    pairs = pairs.select("node", (-F.col("last")).alias("leader"))
    labels = components(stored(leader_links(pairs, sets, least), "minmax-links"))
    labels = stored(labels, "minmax-labels")

    placed = shared.select("key", "node", "size").join(labels, "node", "left")
    placed = placed.select("key", "node", "size", F.coalesce("component", "node").alias("label"))
    open_ = stored(open_buckets(placed), "minmax-open")
    members = stored(placed.join(open_, "key"), "minmax-members")
    joined = components(bucket_links(members, sets, least))
    joined = stored(joined.toDF("component", "root"), "minmax-roots")

    class_of = classes.select("node", "s1", "s2").join(labels, "node", "left")
    class_of = class_of.withColumn("component", F.coalesce("component", "node"))
    class_of = class_of.join(joined, "component", "left")
    class_of = class_of.select("s1", "s2", F.coalesce("root", "component").alias("root"))
    ids = classes.select(F.col("node").alias("root"), F.col("doc_id").alias("least_id"))
    class_of = stored(class_of.join(ids, "root").select("s1", "s2", "least_id"), "minmax-ids")
    every = found.join(class_of, ["s1", "s2"], "left")
    component = F.coalesce("least_id", "doc_id")
    return every.select(
        shown_id("doc_id").alias("doc_id"),
        F.col("size").alias("n_shingles"),
        F.when(component < F.lit(1 << 62), component).alias("component"),
        (F.col("doc_id") == component).alias("kept"),
    )


def sets_asked(
    docs: DataFrame, asked: DataFrame, id_col: str, text_col: str, words: int
) -> DataFrame:
    """node, runs: the sets of the rows in `asked` (node, doc_id, row), read once more."""
    wanted = stored(asked, "minmax-asked")
    texts = docs.select(
        node_id(id_col, text_col).alias("doc_id"),
        row_key(text_col).alias("row"),
        whole_text(text_col).alias("text"),
    )
    # A bitmap of fixed size keeps most other texts out of the shuffle.
    likely = marked(texts, bitmap(wanted, "doc_id", "row"), "likely", "doc_id", "row")
    # Rows that repeat an id and a text are merged before they travel.
    once = likely.filter("likely").groupBy("doc_id", "row").agg(F.first("text").alias("text"))
    chosen = once.join(wanted, ["doc_id", "row"])
    return chosen.select("node", sets_of(F.col("text"), words).alias("runs"))
