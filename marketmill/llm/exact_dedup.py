"""Exact deduplication by progressive refinement, in built-in functions only.

Rows are first told apart by the length of their normalised text, then by a hash of its
first characters, and only rows that still share both with another row are hashed in full.
What survives a stage is handed to the next as a bitmap of hashed keys: 2**22 bits, at most
65,536 rows of 64 bits, whatever the size of the corpus. Keys that share a bit by chance
cost a needless hash and nothing else, because every stage groups by its exact key. No text
is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.llm.common import SPACES, spare, stored, whole_text

BITMAP_BITS = 22
PREFIX_CHARACTERS = 64


def normalised(text: str) -> Column:
    """Each run of ASCII white space as one space; null as empty."""
    return F.regexp_replace(whole_text(text), SPACES, " ")


def _word(place: Column) -> Column:
    return F.shiftright(place, 6)


def bitmap(keys: DataFrame, *columns: str) -> DataFrame:
    """Bits of the hashed keys, 64 to a row: at most 2**22 / 64 rows (`word`, `mask`)."""
    placed = keys.select(_place(*columns).alias("place"))
    bit = F.expr("shiftleft(1L, CAST(place & 63 AS INT))")
    return placed.groupBy(_word(F.col("place")).alias("word")).agg(F.bit_or(bit).alias("mask"))


def _place(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << BITMAP_BITS))


def marked(rows: DataFrame, bits: DataFrame, flag: str, *columns: str) -> DataFrame:
    """`rows` with `flag`: whether the bit of their key is set. `bits` has a fixed bound."""
    place, word, mask = spare(rows, "_place", "_word", "_mask")
    placed = rows.withColumn(place, _place(*columns))
    placed = placed.withColumn(word, _word(F.col(place)))
    joined = placed.join(F.broadcast(bits.toDF(word, mask)), word, "left")
    is_set = F.expr(f"(shiftrightunsigned({mask}, CAST({place} & 63 AS INT)) & 1L) = 1L")
    found = joined.withColumn(flag, F.coalesce(is_set, F.lit(False)))
    return found.drop(place, word, mask)


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_all: bool = False,
) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical after `normalised`; null counts as empty. Of
    equal texts the row with the smallest id stays (null ids come last; of rows that repeat
    one id and text, one stays). text_sha256 is null for rows that no stage had to read in
    full, unless `digest_all`. Other columns of `docs` are not looked at.
    """
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), normalised(text_col).alias("body"))
    keyed = texts.withColumns(
        {
            "length": F.octet_length("body"),
            "head": F.xxhash64(F.substring("body", 1, PREFIX_CHARACTERS)),
        }
    )
    narrow = stored(keyed.select("length", "head"), "exact-keys")
    lengths = narrow.groupBy("length").count().filter("count > 1")
    sharing = marked(narrow, bitmap(lengths, "length"), "again", "length").filter("again")
    heads = sharing.groupBy("length", "head").count().filter("count > 1")
    flagged = marked(keyed, bitmap(heads, "length", "head"), "again", "length", "head")
    digest = F.sha2(F.col("body"), 256)
    hashed = stored(
        flagged.select(
            "doc_id",
            "again",
            (digest if digest_all else F.when(F.col("again"), digest)).alias("text_sha256"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "exact-hashes",
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))
    groups = (
        hashed.filter("again")
        .groupBy("text_sha256")
        .agg(F.count(F.lit(1)).alias("group_size"), first.alias("first"))
        .filter("group_size > 1")
    )
    alone = hashed.filter("NOT again").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        "text_sha256",
    )
    # Written first, so that the join has two plain exchanges and a hot text can be split.
    same = hashed.filter("again").join(stored(groups, "exact-groups"), "text_sha256", "left")
    single = F.col("first").isNull()
    return alone.unionByName(
        same.select(
            "doc_id",
            F.when(single, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
            (single | (F.col("_row") == F.col("first._row"))).alias("kept"),
            "text_sha256",
        )
    )
