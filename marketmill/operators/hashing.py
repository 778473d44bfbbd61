"""Orders and numbers rows by a hash of their key, without one global sort.

The hash is hex text (MD5), so its prefixes are evenly filled buckets whatever the
keys look like, and any SQL engine can repeat it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HEX_STEP = 4  # digits looked at per pass: at most 16 ** 4 = 65,536 counts come back
BUCKET_DIGITS = 3  # 16 ** 3 = 4,096 buckets when numbering
SMALL_BUCKET = 10_000


def key_hash(keys: Sequence[Column | str], salt: str = "") -> Column:
    parts = [
        F.coalesce((F.col(key) if isinstance(key, str) else key).cast("string"), F.lit(""))
        for key in keys
    ]
    return F.md5(F.concat_ws("|", *parts, F.lit(salt)).cast("binary"))


def nth_by_hash(df: DataFrame, hashed: Column, key: str, n: int) -> tuple[str, object] | None:
    """(hash, key) of the `n`-th row in hash order; None when n is 0.

    Counts per hash prefix narrow the place down; only the last, small bucket is
    sorted, and one row of it is fetched. No rows are shuffled.
    """
    if n <= 0:
        return None
    keyed = df.select(hashed.alias("h"), F.col(key).alias("k"))
    prefix, left = "", n
    while len(prefix) < 32:
        digits = len(prefix) + HEX_STEP
        counts = {
            row["p"]: row["n"]
            for row in keyed.where(F.col("h").startswith(prefix))
            .groupBy(F.substring("h", 1, digits).alias("p"))
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        }
        for candidate in sorted(counts):
            if left <= counts[candidate]:
                break
            left -= counts[candidate]
        else:
            raise ValueError(f"fewer than {n} rows")
        prefix = candidate
        if counts[prefix] <= SMALL_BUCKET:
            break
    row = (
        keyed.where(F.col("h").startswith(prefix)).orderBy("h", "k").offset(left - 1).first()
    )
    return row["h"], row["k"]


def up_to(hashed: Column, key: str, end: tuple[str, object] | None) -> Column:
    """True for the rows of the hash order that end with `end`."""
    if end is None:
        return F.lit(False)
    last_hash, last_key = end
    return (hashed < last_hash) | ((hashed == last_hash) & (F.col(key) <= F.lit(last_key)))


def number_by_hash(
    df: DataFrame, keys: Sequence[str], name: str, start: Column
) -> DataFrame:
    """Adds `name`: start + 1, start + 2, ... in hash order of unique `keys`.

    Each hash bucket is numbered on its own and moved by the rows before it. The
    table of offsets has at most 4,096 rows, which is what makes broadcasting it and
    running its sum in one task safe at any size of `df`.
    """
    hashed = df.withColumn("_hash", key_hash(keys)).withColumn(
        "_bucket", F.substring("_hash", 1, BUCKET_DIGITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    return (
        hashed.withColumn("_place", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (start + F.col("_offset") + F.col("_place")).cast("bigint"))
        .drop("_hash", "_bucket", "_place", "_offset")
    )
