"""The searchable catalog: descriptions in, nearest descriptions out."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from marketmill.functions.vectors import checked_vector
from marketmill.operators.descriptions import ordered_catalog_rows
from marketmill.operators.embed import DIMENSIONS
from marketmill.operators.latest import latest_per_key
from marketmill.operators.nearest import TOP_K, nearest
from marketmill.operators.upsert import upsert
from marketmill.schemas import CATALOG_COLUMNS
from marketmill.session import scratch_path
from marketmill.sources.manifests import read_manifests
from marketmill.sources.tables import Warehouse

CATALOG_TABLE = "catalog_embeddings"
CATALOG_NAMESPACE = "catalog"
CATALOG_SCHEMA = (
    "id bigint, source string, model_name string, column_name string, "
    "description string, embedding array<float>, updated_at timestamp"
)
UPDATED = ("description", "embedding", "updated_at")

TEXTS_TABLE = "embedded_texts"
TEXTS_SCHEMA = "model string, digest string, embedding array<float>"
TEXTS_PER_RUN = 1_000_000  # embedded and stored at a time: what a run that is cut off loses

Embed = Callable[[DataFrame], DataFrame]


def catalog_keys() -> dict[str, Column]:
    """A model's own row has no column name; for the key that is the empty name."""
    return {
        "source": F.col("source"),
        "model_name": F.col("model_name"),
        "column_name": F.coalesce("column_name", F.lit("")),
    }


def deduplicated(catalog: DataFrame) -> DataFrame:
    """The newest row of every key; a missing time counts as newest, then the higher id."""
    newest = [F.col("updated_at").desc_nulls_first(), F.col("id").desc()]
    return latest_per_key(catalog, list(catalog_keys().values()), newest)


def upserted(
    catalog: DataFrame, batch: DataFrame, newest_first: Sequence[Column], rows: int | None = None
) -> DataFrame:
    """The catalog, of so many `rows` if that is known, after a batch with the same columns
    (`id` excepted)."""
    return upsert(catalog, batch, catalog_keys(), UPDATED, "id", newest_first, rows=rows)


def ensure_catalog(warehouse: Warehouse) -> DataFrame:
    """The catalog table as it is stored, created if need be."""
    warehouse.create_namespace(CATALOG_NAMESPACE)
    if not warehouse.exists(CATALOG_NAMESPACE, CATALOG_TABLE):
        empty = warehouse.spark.createDataFrame([], CATALOG_SCHEMA)
        warehouse.replace(empty, CATALOG_NAMESPACE, CATALOG_TABLE)
    return warehouse.read(CATALOG_NAMESPACE, CATALOG_TABLE)


def repeated_keys(catalog: DataFrame) -> DataFrame:
    """The keys of more than one row; only key columns are read and counted."""
    rows = catalog.select(*(key.alias(name) for name, key in catalog_keys().items()))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def unique_catalog(warehouse: Warehouse) -> DataFrame:
    """The catalog table with one row per key.

    Updates keep keys unique, so only a table that was filled in another way is ever
    written anew, once. Readers may then take it as it is.
    """
    catalog = ensure_catalog(warehouse)
    if repeated_keys(catalog).isEmpty():
        return catalog
    warehouse.replace(deduplicated(catalog), CATALOG_NAMESPACE, CATALOG_TABLE)
    return warehouse.read(CATALOG_NAMESPACE, CATALOG_TABLE)


def known_texts(warehouse: Warehouse, model: str) -> DataFrame:
    """digest, embedding: the texts that `model` has embedded, ever."""
    warehouse.create_namespace(CATALOG_NAMESPACE)
    if not warehouse.exists(CATALOG_NAMESPACE, TEXTS_TABLE):
        empty = warehouse.spark.createDataFrame([], TEXTS_SCHEMA)
        warehouse.publish(warehouse.stage(empty, CATALOG_NAMESPACE, TEXTS_TABLE))
    stored = warehouse.read(CATALOG_NAMESPACE, TEXTS_TABLE)
    return stored.where(F.col("model") == model).select("digest", "embedding")


def embedded_by_digest(
    warehouse: Warehouse,
    rows: DataFrame,
    embed: Embed,
    model: str,
    size: int = DIMENSIONS,
    texts_per_run: int = TEXTS_PER_RUN,
) -> DataFrame:
    """`rows` with `embedding`, by the SHA-256 of `description`.

    Each different text is embedded once for a `model`: what is stored is not embedded
    again, and the texts that are missing go to the store in runs of about `texts_per_run`,
    so a job that is cut off goes on behind its last whole run. The embedder gets `digest`
    and `description`.
    """
    spark = warehouse.spark
    keyed = rows.withColumn("digest", F.sha2(F.coalesce("description", F.lit("")).cast("binary"), 256))
    texts = keyed.groupBy("digest").agg(F.first("description").alias("description"))
    missing = texts.join(known_texts(warehouse, model).select("digest"), "digest", "left_anti")
    path = scratch_path(spark, "missing-texts")
    counted = Observation()
    missing.observe(counted, F.count(F.lit(1)).alias("texts")).write.option(
        "compression", "zstd"
    ).parquet(path)
    runs = math.ceil(counted.get["texts"] / texts_per_run)
    for run in range(runs):
        dealt = F.pmod(F.xxhash64("digest"), F.lit(runs)) == run
        vectors = embed(spark.read.parquet(path).where(dealt)).select(
            F.lit(model).alias("model"), "digest", checked_vector("embedding", size).alias("embedding")
        )
        warehouse.append(vectors, CATALOG_NAMESPACE, TEXTS_TABLE)
    found = keyed.join(known_texts(warehouse, model), "digest").drop("digest")
    return found.withColumn("embedding", checked_vector("embedding", size))


def index_catalog(
    warehouse: Warehouse,
    manifests: str,
    embed: Embed | None,
    run_at: datetime,
    multi_line: bool = True,
    size: int = DIMENSIONS,
    model: str = "default",
) -> dict[str, int]:
    """Read the documents, embed their descriptions and bring the catalog up to date.

    Returns `{"stored": n, "skipped": m}`: without an embedder nothing is stored and
    all rows are counted as skipped. Texts that `model` (a name for the embedder) has
    embedded in an earlier run, also in one that was cut off, are not embedded again. Of
    descriptions of one key the last one wins, by file and by place in the file. A vector
    of another `size` fails the run.
    """
    spark = warehouse.spark
    rows = ordered_catalog_rows(read_manifests(spark, manifests, multi_line))
    if embed is None:
        return {"stored": 0, "skipped": rows.count()}
    catalog = unique_catalog(warehouse)
    path = scratch_path(spark, "embedded")
    now = F.lit(run_at.isoformat(sep=" ")).cast("timestamp")
    found = embedded_by_digest(warehouse, rows, embed, model, size)
    found.withColumn("updated_at", now).write.option("compression", "zstd").parquet(path)
    batch = spark.read.parquet(path)
    newest_first = [F.col("manifest").desc(), F.col("position").desc()]
    changed = upserted(catalog, batch, newest_first, catalog.count())
    warehouse.replace(changed, CATALOG_NAMESPACE, CATALOG_TABLE)
    return {"stored": batch.count(), "skipped": 0}


def retrieve(catalog: DataFrame, question: Sequence[float], k: int = TOP_K) -> DataFrame:
    """(source, model_name, column_name, description, similarity) of the nearest rows."""
    kept = catalog.select("id", *CATALOG_COLUMNS, "embedding")
    return nearest(kept, question, k).select(*CATALOG_COLUMNS, "similarity")


def context_line() -> Column:
    """`- [column] model.name: text`, or `- [model] model: text`."""
    name = F.when(
        F.coalesce("column_name", F.lit("")) != "",
        F.concat("model_name", F.lit("."), "column_name"),
    ).otherwise(F.col("model_name"))
    return F.concat(F.lit("- ["), "source", F.lit("] "), name, F.lit(": "), "description")


def context(hits: DataFrame, by: str, rank: str = "rank") -> DataFrame:
    """(by, context): the lines of each question's hits, best first.

    A question has k hits, so the list that is collected for it is k lines long.
    """
    lines = F.sort_array(F.collect_list(F.struct(F.col(rank), context_line().alias("line"))))
    return hits.groupBy(by).agg(F.array_join(lines["line"], "\n").alias("context"))


def question_hits(
    catalog: DataFrame, question: Sequence[float], k: int = TOP_K
) -> list[tuple[str, float | None]]:
    """(line, similarity) of one question's `k` hits, best first; none in an empty catalog."""
    hits = retrieve(catalog, question, k).select(context_line().alias("line"), "similarity")
    return [tuple(row) for row in hits.collect()]
