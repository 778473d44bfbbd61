"""Insert, or update where the key exists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.operators.hashing import number_by_hash
from marketmill.operators.latest import latest_per_key
from marketmill.session import scratch_path


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Mapping[str, Column],
    updated: Sequence[str],
    id_column: str,
    newest_first: Sequence[Column],
    highest: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """`target` after `batch`, as a new DataFrame with the columns of `target`.

    `keys` names the key expressions over columns both sides share. A batch row with a
    NULL key fails the run (coalesce where NULL is a key value of its own). Rows of the
    target keep their id and their own key columns, and take `updated` from the batch;
    other batch rows are added under new ids above `highest` (of the target's by default). Among batch rows of one key the
    first in `newest_first` order wins.

    The winners of the batch are written to the shared folder at once, each with the columns
    that its row of the target keeps: the batch is read one time, and of the target that step
    reads no column that is updated. If the batch has all keys of the target, which is told by
    the target's number of `rows`, no more is read of it. Otherwise the updates are one left join, which Spark runs without moving the
    target when the rows of known keys are small.
    """
    key_names = [f"_key_{name}" for name in keys]
    with_keys = dict(zip(key_names, keys.values(), strict=True))
    target_keyed = target.withColumns(with_keys)
    missing = F.raise_error(F.lit(f"the batch has a NULL among its keys {', '.join(keys)}"))
    batch_keys = {name: F.coalesce(key, missing) for name, key in with_keys.items()}
    winners = latest_per_key(batch.withColumns(batch_keys), key_names, newest_first)
    taken = [name for name in target.columns if name in batch.columns and name != id_column]
    own = [name for name in target.columns if name not in updated]
    of_target = target_keyed.select(*key_names, F.struct(*own).alias("_known"))
    path = scratch_path(batch.sparkSession, "upsert-batch")
    (
        winners.select(*key_names, *taken)
        .join(of_target, key_names, "left")
        .write.option("compression", "zstd")
        .parquet(path)
    )
    newest = batch.sparkSession.read.parquet(path)

    known = newest.where("_known IS NOT NULL")
    if rows is not None and known.count() == rows:
        kept = known.select(
            *(F.col(name) if name in updated else F.col("_known")[name].alias(name) for name in target.columns)
        )
    else:
        changes = known.select(*key_names, F.struct(*updated).alias("_new"))
        kept = target_keyed.join(changes, key_names, "left").select(
            *(
                F.when(F.col("_new").isNotNull(), F.col("_new")[name])
                .otherwise(F.col(name))
                .alias(name)
                if name in updated
                else F.col(name)
                for name in target.columns
            )
        )

    if highest is None:
        highest = target.select(F.coalesce(F.max(id_column), F.lit(0)).alias("highest")).scalar()
    added = number_by_hash(newest.where("_known IS NULL"), key_names, id_column, start=highest)
    return kept.unionByName(added.select(*target.columns))


def without(df: DataFrame, condition: Column) -> DataFrame:
    """`df` after deleting the rows where `condition` is true (unknown is kept)."""
    return df.where(~F.coalesce(condition, F.lit(False)))
