"""SimHash near-duplicates by tiled exact comparison.

Texts become 64-bit fingerprints; equal ones are one node. A tile holds fingerprints whose
blocks of bits have the same population counts, at most about 4,096 of them: two
fingerprints that differ in r bits have block counts that differ by r in sum at most, so a
pair of tiles beyond the radius is skipped without losing a link. The tiles left are
compared pair by pair, exclusive-or and bit count in numpy, and each comparison hands out a
spanning forest of its links, never the pairs of a group. The blocks get finer as the
corpus grows, which changes the number of tile pairs and no result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import bytes_of, node_id, row_key, shown_id, spare, stored, whole_text
from marketmill.llm.components import components
from marketmill.llm.exact_dedup import bitmap, marked

SEED = 42
BITS = 64
TILE = 4096
NODES_PER_CELL = 256  # aimed at
COUNT_BASE = 128  # block counts are digits of this base; a sum of digits never reaches it
SLICE = 16_384  # shingles whose bits are counted at a time
CELL_BASE = 1024  # cells of population counts below a band, and room between bands
PRINT_WORDS = 4  # of 64 bits, in the fingerprint of a set of runs
PRINT_SLICE = 255  # runs whose bits are counted at a time, in a byte
MISSED = 1e-6  # chance at most that two sets of the least similarity are no candidates
TILE_RUNS = 500_000  # of words, in a tile of a family
ROWS = 256  # rows of a tile that are compared at a time
LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of each run of `size` words (of all words if fewer), as 8 big-endian bytes."""
    words = text.lower().split()
    if not words:
        return np.empty((0, 8), dtype=np.uint8)
    digest = xxhash.xxh64_digest
    if len(words) <= size:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    joined = b"".join([digest(run, SEED) for run in runs])
    return np.frombuffer(joined, dtype=np.uint8).reshape(-1, 8)


def fingerprint(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; zero without hashes."""
    counts = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), SLICE):
        counts += np.unpackbits(hashes[start : start + SLICE], axis=1).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(text: Column, size: int) -> Column:
    """The fingerprint of a text as a whole number of 64 bits."""

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            values = [fingerprint(shingle_hashes(found, size)) for found in bytes_of(column)]
            yield pa.array(values, pa.int64())

    return F.arrow_udf(each, "long")(text)


def blocks_for(nodes: int, radius: int) -> int:
    """Blocks of a fingerprint: those that skip most pairs of tiles.

    Finer blocks are tried until a usual tile would hold NODES_PER_CELL nodes or fewer.
    """
    best = tried = 1
    while tried < 16 and nodes / cells(tried) > NODES_PER_CELL:
        tried *= 2
        if compared_share(tried, radius) < compared_share(best, radius):
            best = tried
    return best


def compared_share(blocks: int, radius: int) -> float:
    """About how much of all pairs is in tiles within the radius."""
    near = sum(
        2**k * math.comb(blocks, k) * math.comb(radius, k) for k in range(min(blocks, radius) + 1)
    )
    return min(1.0, near / cells(blocks))


def cells(blocks: int) -> float:
    """How many count vectors of random fingerprints are about equally usual."""
    deviation = math.sqrt(BITS / blocks) / 2
    return max(1.0, 2 * math.sqrt(math.pi) * deviation) ** blocks


def cell_of(value: Column, blocks: int) -> Column:
    """The block counts of a fingerprint, as digits of one whole number."""
    width = BITS // blocks
    base = COUNT_BASE if blocks <= 8 else 8  # 16 blocks of 4 bits: digits of 3 bits
    ones = F.lit(-1 if width == BITS else (1 << width) - 1).cast("long")
    digits = [
        F.bit_count(F.shiftrightunsigned(value, i * width).bitwiseAND(ones)).cast("long")
        * F.lit(base**i).cast("long")
        for i in range(blocks)
    ]
    return sum(digits[1:], digits[0])


def offsets(blocks: int, radius: int) -> list[int]:
    """Differences of cells that may hold links; of each and its opposite only one."""
    base = COUNT_BASE if blocks <= 8 else 8
    found = set()
    for changed in range(min(blocks, radius) + 1):
        for places in itertools.combinations(range(blocks), changed):
            for steps in itertools.product(range(-radius, radius + 1), repeat=changed):
                if 0 not in steps and sum(map(abs, steps)) <= radius:
                    found.add(sum(s * base**p for s, p in zip(steps, places, strict=True)))
    return sorted(step for step in found if step >= 0)


def band_of(size: Column, least: float) -> Column:
    """Sizes of which the smaller is `least` of the larger or more: same or adjacent bands."""
    width = max(1.001 * math.log(1 / least), 1e-9)  # a little wide, against rounding
    return F.floor(F.log(F.greatest(size, F.lit(1))) / width)


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Gives linked places one label, the smallest; `labels` point at places."""
    while True:
        left, right = labels[a], labels[b]
        apart = left != right
        if not apart.any():
            return labels
        high, low = np.maximum(left, right)[apart], np.minimum(left, right)[apart]
        np.minimum.at(labels, high, low)
        while (labels[labels] != labels).any():
            labels = labels[labels]


def forest(
    values: np.ndarray, nodes: np.ndarray, others: np.ndarray, other_nodes: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect whatever is linked between two tiles (or within one)."""
    counts, other_counts = np.bitwise_count(values), np.bitwise_count(others)
    order, other_order = np.argsort(counts, kind="stable"), np.argsort(other_counts, kind="stable")
    values, nodes, counts = values[order], nodes[order], counts[order].astype(np.int64)
    others, other_nodes = others[other_order], other_nodes[other_order]
    other_counts = other_counts[other_order].astype(np.int64)
    labels = np.arange(len(values) + len(others))
    for start in range(0, len(values), ROWS):
        part = values[start : start + ROWS]
        low = np.searchsorted(other_counts, counts[start] - radius)
        high = np.searchsorted(other_counts, counts[start + len(part) - 1] + radius, "right")
        near = np.bitwise_count(part[:, None] ^ others[None, low:high]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            labels = merge(labels, i + start, j + low + len(values))
    return moved_links(labels, np.concatenate([nodes, other_nodes]))


def moved_links(labels: np.ndarray, every: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A link from each place whose label is another place to that one, as nodes."""
    moved = np.flatnonzero(labels != np.arange(len(labels)))
    a, b = every[moved], every[labels[moved]]
    return a[a != b], b[a != b]


def print_forest(
    x: tuple[np.ndarray, np.ndarray, np.ndarray],
    y: tuple[np.ndarray, np.ndarray, np.ndarray],
    radius: int,
    least: float,
) -> tuple[np.ndarray, np.ndarray]:
    """As `forest`, for tiles of (rows of PRINT_WORDS words, nodes, sizes of the sets).

    Of two linked sizes the smaller is `least` of the larger or more.
    """
    order, other_order = np.argsort(x[2], kind="stable"), np.argsort(y[2], kind="stable")
    values, nodes, sizes = (part[order] for part in x)
    others, other_nodes, other_sizes = (part[other_order] for part in y)
    others = np.ascontiguousarray(others.T)
    labels = np.arange(len(values) + len(other_nodes))
    for start in range(0, len(values), ROWS):
        part = values[start : start + ROWS]
        # A little wide, against rounding; sizes are compared again below.
        low = np.searchsorted(other_sizes, 0.999 * least * sizes[start])
        high = np.searchsorted(other_sizes, 1.001 * sizes[start + len(part) - 1] / least, "right")
        differing = np.zeros((len(part), high - low), dtype=np.uint16)
        for k in range(PRINT_WORDS):
            differing += np.bitwise_count(part[:, k, None] ^ others[k, None, low:high])
        i, j = np.nonzero(differing <= radius)
        one, two = sizes[i + start], other_sizes[j + low]
        fits = np.minimum(one, two) >= least * np.maximum(one, two)
        if fits.any():
            labels = merge(labels, i[fits] + start, j[fits] + low + len(values))
    return moved_links(labels, np.concatenate([nodes, other_nodes]))


def set_tile(band: Column, prints: Column, radius: int) -> Column:
    """The tile of a set: its band of sizes, and the population count of its print in cells.

    At radii for which finer blocks skip no more (`compared_share`), one block is the print.
    """
    ones = sum((F.bit_count(prints[k]) for k in range(1, PRINT_WORDS)), F.bit_count(prints[0]))
    return band * F.lit(CELL_BASE) + F.floor(ones / count_width(radius))


def count_width(radius: int) -> int:
    """Population counts of a cell: few cells, of which those beyond the radius are skipped."""
    return max(1, radius // 2)


def set_steps(radius: int) -> Column:
    """Differences of `set_tile` that may hold links, of each pair of tiles one.

    Counts in cells that are k apart differ by more than (k - 1) * width, and prints differ in
    as many bits at least.
    """
    width = count_width(radius)
    most = (radius + width - 1) // width
    steps = [*range(most + 1), *range(CELL_BASE - most, CELL_BASE + most + 1)]
    return F.array(*[F.lit(step).cast("long") for step in steps])


def tile_steps(blocks: int, radius: int) -> Column:
    """Cell differences of tiles that may hold links, each pair of tiles once."""
    return F.array(*[F.lit(step).cast("long") for step in offsets(blocks, radius)])


def fingerprint_links(nodes: DataFrame, radius: int) -> DataFrame:
    """Links (`a`, `b`) that connect all nodes whose fingerprints differ in `radius` bits.

    `nodes` is a stored table of distinct `fingerprint`s and their `node` numbers.
    """
    blocks = blocks_for(nodes.count(), radius)
    placed = nodes.withColumn("tile", cell_of(F.col("fingerprint"), blocks))

    def compared(x: pa.StructArray, y: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        return forest(
            x.field(0).to_numpy().view(np.uint64), x.field(1).to_numpy(),
            y.field(0).to_numpy().view(np.uint64), y.field(1).to_numpy(), radius,
        )

    return tile_links(
        placed, ["fingerprint", "node"], TILE, tile_steps(blocks, radius), compared
    )


def print_links(nodes: DataFrame, radius: int, least: float) -> DataFrame:
    """Links (`a`, `b`) that connect all nodes whose `prints` differ in `radius` bits.

    `nodes` is a stored table of `prints` (PRINT_WORDS words), `node` numbers and `size`s of
    sets. Of two linked sizes the smaller is `least` of the larger or more: a tile holds
    sizes of one band and prints of like population counts; bands that are apart and counts
    that differ by more than `radius` are not compared. Sets so small that any
    other shares less than `least` with them are left out.
    """
    smallest = math.ceil(least / (1 - least) - 1e-9) if least < 1 else math.inf
    placed = nodes.filter(F.col("size") >= F.lit(float(smallest)))
    placed = placed.withColumn("tile", set_tile(band_of(F.col("size"), least), F.col("prints"), radius))
    words = [F.col("prints")[k].alias(f"p{k}") for k in range(PRINT_WORDS)]
    placed = placed.select("tile", "node", "size", *words)
    # Small corpora have more tiles than size asks for, so that all tasks have some.
    rows = min(TILE, max(512, nodes.count() // 64))

    def arrays(rows: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        node, size, *prints = (field.to_numpy() for field in rows.flatten())
        return np.stack(prints, axis=1).view(np.uint64), node, size

    def compared(x: pa.StructArray, y: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
        return print_forest(arrays(x), arrays(y), radius, least)

    known = ["node", "size", *(f"p{k}" for k in range(PRINT_WORDS))]
    return tile_links(placed, known, rows, set_steps(radius), compared)


def tile_links(
    placed: DataFrame,
    known: list[str],
    rows: int,
    steps: Column,
    found_in: Callable[[pa.StructArray, pa.StructArray], tuple[np.ndarray, np.ndarray]],
) -> DataFrame:
    """The links that `found_in` finds in all pairs of tiles that differ by one of `steps`.

    Of `placed` a tile holds the columns `known`; one of more than some `rows` is chunked.
    """
    held = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = stored(
        placed.join(held, "tile")
        .groupBy("tile", chunk.alias("chunk"))
        .agg(F.collect_list(F.struct(*known)).alias("rows")),
        "tiles",
    )
    listed = tiles.select("tile", "chunk")
    left = listed.select(
        F.col("tile").alias("a"), F.col("chunk").alias("i"), F.explode(steps).alias("step")
    )
    left = left.withColumn("b", F.col("a") + F.col("step")).drop("step")
    right = listed.select(F.col("tile").alias("b"), F.col("chunk").alias("j"))
    pairs = left.join(right, "b").filter("a <> b OR i <= j")
    of_a = tiles.select(F.col("tile").alias("a"), F.col("chunk").alias("i"), F.col("rows").alias("x"))
    of_b = tiles.select(F.col("tile").alias("b"), F.col("chunk").alias("j"), F.col("rows").alias("y"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            x, y = batch.column("x"), batch.column("y")
            for k in range(batch.num_rows):
                found = found_in(x[k].values, y[k].values)
                a.append(found[0])
                b.append(found[1])
            columns = [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))]
            yield pa.RecordBatch.from_arrays(columns, schema=LINKS)

    units = pairs.join(of_a, ["a", "i"]).join(of_b, ["b", "j"]).select("x", "y")
    return units.mapInArrow(compared, "a long, b long")


def labelled(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """`nodes` with `component`, the smallest node that is linked to theirs."""
    joined = nodes.join(components(links), "node", "left")
    return joined.withColumn("component", F.coalesce("component", "node"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One row per row of `docs`: doc_id, fingerprint (64 bits), component.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are `words`
    words joined by a space (all words if there are fewer); a bit is set if over half of
    the shingles' XXH64 have it. Fingerprints link at `radius` or fewer differing bits;
    `component` is the smallest id reachable. Null, empty and blank texts have fingerprint
    zero, linked like any other. Ids are whole numbers below 2**62; a null id counts as
    larger than all others and is handed out as null again. Other columns are not looked at.
    """
    found = stored(
        docs.select(
            node_id(id_col, text_col).alias("doc_id"),
            fingerprints(whole_text(text_col), words).alias("fingerprint"),
        ),
        "fingerprints",
    )
    nodes = found.groupBy("fingerprint").agg(F.min("doc_id").alias("node"))
    nodes = stored(nodes, "fingerprint-nodes")
    by_print = labelled(nodes, fingerprint_links(nodes, radius)).drop("node")
    return found.join(by_print, "fingerprint").select(
        shown_id("doc_id").alias("doc_id"), "fingerprint", shown_id("component").alias("component")
    )


def run_set(text: bytes, size: int) -> np.ndarray:
    """The different runs of `size` words of a text, as sorted hashes."""
    return np.unique(shingle_hashes(text, size).view("<i8").ravel())


def set_print(runs: np.ndarray) -> np.ndarray:
    """PRINT_WORDS words of bits that are set in over half of the different runs' hashes."""
    steps = np.arange(1, PRINT_WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros(64 * PRINT_WORDS, dtype=np.int64)
    for start in range(0, len(runs), PRINT_SLICE):
        # SplitMix64 makes several words of each hash.
        z = runs[start : start + PRINT_SLICE].view(np.uint64)[:, None] + steps
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
        counts += np.unpackbits(z.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(runs)).view(np.int64)


def halves(n: int) -> np.ndarray:
    """Chances of 0 to n heads."""
    return np.array([math.comb(n, k) / 2**n for k in range(n + 1)])


def differing_share(shared: int, one: int, two: int) -> float:
    """Chance that a bit differs between two sets with `shared` runs, and `one` and `two` more."""
    set_of = []
    for more in (one, two):
        above, n = halves(more), shared + more
        set_of.append(np.array([above[max(0, n // 2 + 1 - k) :].sum() for k in range(shared + 1)]))
    x, y = set_of
    return float((halves(shared) * (x * (1 - y) + y * (1 - x))).sum())


def radius_for(least: float) -> int:
    """Differing bits that two sets that share `least` exceed with a chance of MISSED at most.

    The share of bits is the highest of small sets; it nears arccos(cosine) / pi as sets grow.
    """
    worst = math.acos(2 * least / (1 + least)) / math.pi
    for a in range(1, 41):
        for b in range(a, math.floor(a / least + 1e-9) + 1):
            shared = math.ceil(least * (a + b) / (1 + least) - 1e-9)
            if shared <= a:
                worst = max(worst, differing_share(shared, a - shared, b - shared))
    bits = 64 * PRINT_WORDS
    beyond, radius = 1.0, -1
    while beyond > MISSED:
        radius += 1
        beyond -= math.comb(bits, radius) * worst**radius * (1 - worst) ** (bits - radius)
    return radius


def marks(text: Column, run: int) -> Column:
    """Fingerprint, size and a 128-bit hash of the set of runs of a text."""

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            prints, first, second, sizes = [], [], [], []
            for found in bytes_of(column):
                runs = run_set(found, run)
                prints.append(set_print(runs))
                sizes.append(len(runs))
                digest = xxhash.xxh3_128_digest(runs.tobytes())
                first.append(int.from_bytes(digest[:8], "big", signed=True))
                second.append(int.from_bytes(digest[8:], "big", signed=True))
            arrays = [pa.array(x, pa.int64()) for x in (first, second, sizes)]
            arrays.insert(0, pa.array(prints, pa.list_(pa.int64())))
            yield pa.StructArray.from_arrays(arrays, names=["prints", "s1", "s2", "size"])

    schema = "struct<prints: array<bigint>, s1: bigint, s2: bigint, size: bigint>"
    return F.arrow_udf(each, schema)(text)


def run_sets(text: Column, run: int) -> Column:
    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            sets = [run_set(found, run) for found in bytes_of(column)]
            yield pa.array(sets, pa.list_(pa.int64()))

    return F.arrow_udf(each, "array<bigint>")(text)


def similar(
    sets: list[np.ndarray], others: list[np.ndarray], least: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs of sets whose shared part of both is `least` or more."""
    sizes = np.array([len(x) for x in others])
    values = np.concatenate(others)
    owner = np.repeat(np.arange(len(others)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for i, own in enumerate(sets):
        low, high = np.searchsorted(values, own), np.searchsorted(values, own, "right")
        counts = high - low
        ends = np.cumsum(counts)
        at = np.arange(counts.sum()) + np.repeat(low - (ends - counts), counts)
        shared = np.bincount(owner[at], minlength=len(others))
        # Two texts without words have no runs and are equal.
        near = shared >= least * (len(own) + sizes - shared)
        found = np.flatnonzero(near & ((shared > 0) | (len(own) + sizes == 0)))
        a.append(np.full(len(found), i))
        b.append(found)
    return np.concatenate(a), np.concatenate(b)


def verified_links(sets: DataFrame, least: float) -> DataFrame:
    """Links that connect all similar texts of a family; `sets` has family, node, runs.

    A family is cut into tiles by the number of its runs; pairs of tiles are compared.
    """
    size = F.greatest(F.size("runs"), F.lit(1))
    held = sets.groupBy("family").agg(F.ceil(F.sum(size) / TILE_RUNS).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    tiles = stored(
        sets.join(held, "family")
        .groupBy("family", chunk.alias("chunk"))
        .agg(F.collect_list(F.struct("node", "runs")).alias("rows")),
        "family-tiles",
    )
    names = tiles.select("family", F.col("chunk").alias("i"))
    pairs = names.join(names.withColumnRenamed("i", "j"), "family").filter("i < j")
    of_a = tiles.select("family", F.col("chunk").alias("i"), F.col("rows").alias("x"))
    of_b = tiles.select("family", F.col("chunk").alias("j"), F.col("rows").alias("y"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for x, y in zip(batch.column(0), batch.column(batch.num_columns - 1), strict=True):
                nodes, lists = zip(*(
                    (rows.field(0).to_numpy(), [r.values.to_numpy() for r in rows.field(1)])
                    for rows in (x.values, y.values)
                ), strict=True)
                i, j = similar(*lists, least)
                every = np.concatenate(nodes)
                order = np.argsort(every, kind="stable")  # so the least node is the label
                place = np.empty(len(order), dtype=np.int64)
                place[order] = np.arange(len(order))
                labels = merge(np.arange(len(order)), place[i], place[j + len(nodes[0])])
                moved = np.flatnonzero(labels != np.arange(len(labels)))
                a.append(every[order][moved])
                b.append(every[order][labels[moved]])
            columns = [pa.array(np.concatenate(a)), pa.array(np.concatenate(b))]
            yield pa.RecordBatch.from_arrays(columns, schema=LINKS)

    units = pairs.join(of_a, ["family", "i"]).join(of_b, ["family", "j"]).select("x", "y")
    # Most families are one tile, which is compared with itself where it is read.
    within = tiles.select("rows").mapInArrow(compared, "a long, b long")
    return within.unionByName(units.mapInArrow(compared, "a long, b long"))


def similar_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int | None = None,
    run: int = 5,
    least: float = 0.8,
) -> DataFrame:
    """doc_id, row, component, first_row: near-duplicates by SimHash, verified on runs of words.

    Fingerprints of 256 bits of the sets of runs, each run once, make families within
    `radius`, but for those whose numbers of runs differ too much to share `least`. Without
    a `radius`, it is that beyond which a pair that shares `least` lies with a chance of
    MISSED at most. Inside a family, texts link whose sets of runs of `run` words share
    `least` or more of both (a text of fewer words is one run);
    `component` is the smallest id reachable by such links. `least` is above 0. Ids and
    nulls as in `near_duplicates`, a null id as a number from 2**62 on. `row` tells rows
    apart that share an id, `first_row` is that of the component's first row.
    """
    found = stored(
        docs.select(
            node_id(id_col, text_col).alias("doc_id"),
            row_key(text_col).alias("row"),
            marks(whole_text(text_col), run).alias("marks"),
        ).select("doc_id", "row", "marks.*"),
        "marks",
    )
    first = found.groupBy("s1", "s2").agg(
        F.min(F.struct("doc_id", "row")).alias("first"),
        F.first("prints").alias("prints"),
        F.first("size").alias("size"),
    )
    # Rows that share an id may be of several classes: nodes are numbers in the order of ids.
    classes = stored(
        first.select("prints", "s1", "s2", "size", "first.*")
        .orderBy("doc_id", "row", "s1", "s2")
        .withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    links = print_links(classes, radius_for(least) if radius is None else radius, least)
    placed = labelled(classes.select("node", "doc_id", "row"), links)
    placed = stored(placed.withColumnRenamed("component", "family"), "families")
    several = placed.groupBy("family").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    asked = placed.join(several, "family").select("family", "node", "doc_id", "row")
    texts = docs.select(
        node_id(id_col, text_col).alias("doc_id"),
        row_key(text_col).alias("row"),
        whole_text(text_col).alias("text"),
    )
    # A bitmap of fixed size keeps most other texts out of the shuffle.
    likely = marked(texts, bitmap(asked, "doc_id", "row"), "_likely", "doc_id", "row")
    sets = likely.filter("_likely").join(asked, ["doc_id", "row"]).select(
        "family", "node", run_sets(F.col("text"), run).alias("runs")
    )
    sets = stored(sets.dropDuplicates(["node"]), "run-sets")
    linked = labelled(classes.select("node", "s1", "s2"), verified_links(sets, least))
    least_ids = classes.select(
        F.col("node").alias("component"), F.col("doc_id").alias("id"), F.col("row").alias("first_row")
    )
    by_class = linked.join(least_ids, "component").select(
        "s1", "s2", F.col("id").alias("component"), "first_row"
    )
    joined = found.join(by_class, ["s1", "s2"])
    return joined.select("doc_id", "row", "component", "first_row")


def one_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int | None = None,
    run: int = 5,
    least: float = 0.8,
) -> DataFrame:
    """`docs` without its near-duplicates: one row of each component stays, of the smallest id.

    See `similar_documents`. Of rows that repeat that id one stays, and so does one of rows
    without an id if nothing similar has one. Columns are unchanged.
    """
    found = similar_documents(docs, id_col, text_col, radius, run, least)
    keeps = (F.col("doc_id") == F.col("component")) & (F.col("row") == F.col("first_row"))
    node, row, likely = spare(docs, "_node", "_row", "_likely")
    each = found.groupBy("doc_id", "row").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(keeps).alias("keeps")
    )
    told = each.filter("NOT keeps OR n > 1").select(
        F.col("doc_id").alias(node), F.col("row").alias(row), "keeps"
    )
    told = stored(told, "near-copies")
    gone = told.filter("NOT keeps").drop("keeps")
    keyed = docs.withColumns({node: node_id(id_col, text_col), row: row_key(text_col)})
    # Rows whose bit is not set are alone, and need no shuffle.
    flagged = marked(keyed, bitmap(told, node, row), likely, node, row)
    left = flagged.filter(F.col(likely)).join(gone, [node, row], "left_anti")
    left = left.dropDuplicates([node, row])
    columns = [f"`{name}`" for name in docs.columns]
    return flagged.filter(~F.col(likely)).select(*columns).unionByName(left.select(*columns))
