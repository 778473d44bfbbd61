"""Filter interaction audit: what every order of the filters removes at every step.

Documents are reduced to counts of (part, failed filters, marks), a few rows for each part
whatever the corpus. On those the removal step of a document under an order is a min-plus
product: its mask row has 0 where it fails a filter and infinity elsewhere, the inverse
permutation has the step at which each filter comes, and the least sum is the step that
removes it. The counts are then scattered to these steps.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import bytes_of, stored, whole_text

MOST_FILTERS = 7  # whose orders are all tried
SLICE = 1 << 20  # bytes that are cut into words at a time

# The filters of the audit and their bounds.
FILTERS = ("A", "B", "C", "D", "E")
LEAST_WORDS = 100
LEAST_DISTINCT = 80  # percent of the words
MOST_CAPITALS = 10  # percent of the characters
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
CONTINUED = bytes(range(0x80, 0xC0))  # bytes inside a character of UTF-8


def word_counts(text: bytes) -> tuple[int, int]:
    """Words (runs without ASCII white space) and different words, read in slices."""
    words, different = 0, set()
    start = 0
    while start < len(text):
        stop = min(start + SLICE, len(text))
        while stop < len(text) and not text[stop : stop + 1].isspace():
            stop += 1
        found = text[start:stop].split()
        words += len(found)
        different.update(found)
        start = stop
    return words, len(different)


def own_failures(text: bytes) -> int:
    """Bits of the filters A to D that a text fails by itself."""
    words, different = word_counts(text)
    characters = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = (
        words < LEAST_WORDS,
        100 * different < LEAST_DISTINCT * words,
        100 * capitals > MOST_CAPITALS * characters,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << i for i, fails in enumerate(failed) if fails)


def looked_at(text: Column) -> Column:
    """own_failures and SHA-256 of a text."""

    def each(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            found = [(own_failures(x), hashlib.sha256(x).digest()) for x in bytes_of(column)]
            failures = pa.array([f for f, _ in found], pa.int32())
            digests = pa.array([d for _, d in found], pa.binary())
            yield pa.StructArray.from_arrays([failures, digests], names=["failed", "digest"])

    return F.arrow_udf(each, "struct<failed: int, digest: binary>")(text)


def judged(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """part, failed, good, toxic: a row per row of `docs`, `failed` being bits of FILTERS.

    A: under LEAST_WORDS words; B: too few different words; C: too many of `[A-Z]`; D: any of
    SYMBOLS; E: the text of a smaller id again (rows that share the smallest id are not
    copies; a null id counts as larger than all others). Null texts are empty; a null part
    is the empty one. good and toxic: some label of the id says so; a null id has none.
    Other columns of either table are not looked at.
    """
    texts = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit("")).alias("part"),
        looked_at(whole_text(text_col)).alias("seen"),
    )
    facts = stored(texts.select("id", "part", "seen.*"), "audit-texts")
    rank = F.struct(F.col("id").isNull().alias("none"), F.col("id"))
    copied = facts.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first"))
    # Written first, so that the join has two plain exchanges and a hot text can be split.
    copied = stored(copied.filter("n > 1").select("digest", "first"), "audit-copies")
    marked = facts.join(copied, "digest", "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first.id"))
    bit = 1 << FILTERS.index("E")
    marked = marked.select("id", "part", (F.col("failed") + F.when(again, bit).otherwise(0)).alias("failed"))
    said = labels.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("toxic"),
    ).filter("id IS NOT NULL")
    said = said.groupBy("id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    joined = marked.join(stored(said.filter("good OR toxic"), "audit-labels"), "id", "left")
    return joined.select(
        "part",
        "failed",
        F.coalesce("good", F.lit(False)).alias("good"),
        F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def removal_steps(masks: np.ndarray, orders: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Steps (orders x masks) at which each mask is removed, and the inverse permutations.

    `masks` is (masks x filters), true where a filter fails. The step is the minimum over
    filters of 0 or infinity plus the filter's place; infinity is one more than all steps.
    """
    filters = masks.shape[1]
    never = filters + 1
    places = np.empty((len(orders), filters), dtype=np.int64)
    np.put_along_axis(places, np.array(orders), np.arange(1, filters + 1)[None, :], axis=1)
    costs = np.where(masks, 0, never)
    steps = np.full((len(orders), len(masks)), never)
    for f in range(filters):
        np.minimum(steps, places[:, f, None] + costs[None, :, f], out=steps)
    return steps, places


def interactions(
    rows: DataFrame,
    filters: Sequence[str],
    marks: Sequence[str] = (),
    orders: Sequence[str] | None = None,
) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, a `_lost` for each
    mark, shapley: a row for each part, order and step, zeros included.

    `rows` has `part`, `failed` (bits of `filters`, whose names have one letter) and the
    boolean `marks`. removed: what the step removes; kept: what is left after it; redundant:
    what fails the step's filter and was removed before; unique_fails: what fails that
    filter and no other; shapley: what its filter removes, summed over all `orders` (by
    default all permutations, of at most MOST_FILTERS filters). A part without rows has none.
    """
    if orders is None:
        if len(filters) > MOST_FILTERS:
            raise ValueError(f"name the orders of more than {MOST_FILTERS} filters")
        orders = ["".join(order) for order in itertools.permutations(filters)]
    number = {name: i for i, name in enumerate(filters)}
    numbered = [[number[name] for name in order] for order in orders]
    if any(sorted(order) != list(range(len(filters))) for order in numbered):
        raise ValueError("an order has every filter once")
    # At most 2 ** (filters + marks) rows for a part, merged before they are shuffled.
    counted = rows.groupBy("part", "failed", *marks).agg(F.count(F.lit(1)).alias("n"))
    lost = [f"{mark}_lost" for mark in marks]
    names = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]
    schema = "part string, filter_order string, step int, " + ", ".join(f"`{x}` long" for x in names)

    def of_part(found: pd.DataFrame) -> pd.DataFrame:
        failed = found["failed"].to_numpy(np.int64)
        weights = found["n"].to_numpy(np.int64)
        masks = (failed[:, None] >> np.arange(len(filters))) & 1 == 1
        steps, places = removal_steps(masks, numbered)

        def at_steps(counts: np.ndarray) -> np.ndarray:
            """orders x steps: the counts scattered to the steps that remove them."""
            out = np.zeros((len(orders), len(filters) + 2), dtype=np.int64)
            np.add.at(out, (np.arange(len(orders))[:, None], steps), counts[None, :])
            return out[:, 1:-1]

        removed = at_steps(weights)
        order = np.array(numbered)  # the filter of each step
        fails = masks.T @ weights
        alone = (masks & (masks.sum(axis=1) == 1)[:, None]).T @ weights
        of_filter = np.take_along_axis(removed, places - 1, axis=1).sum(axis=0)
        columns = [weights.sum() - removed.cumsum(axis=1), removed, fails[order] - removed, alone[order]]
        columns += [at_steps(weights * found[mark].to_numpy(bool)) for mark in marks]
        columns.append(of_filter[order])
        out = pd.DataFrame({name: x.ravel() for name, x in zip(names, columns, strict=True)})
        out.insert(0, "part", found["part"].iloc[0])
        out.insert(1, "filter_order", np.repeat(orders, len(filters)))
        out.insert(2, "step", np.tile(np.arange(1, len(filters) + 1), len(orders)))
        return out

    return counted.groupBy("part").applyInPandas(of_part, schema)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`interactions` of FILTERS over `docs`, with good_lost and toxic_lost from `labels`."""
    return interactions(judged(docs, labels), FILTERS, ("good", "toxic"))
