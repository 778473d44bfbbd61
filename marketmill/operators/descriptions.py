"""Documented names and descriptions out of nested catalog documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketmill.functions.text import stripped
from marketmill.schemas import CATALOG_COLUMNS


def exploded_nodes(manifests: DataFrame) -> DataFrame:
    """One row per node with its `position`, keeping the other columns of the document."""
    others = [name for name in manifests.columns if name != "nodes"]
    return manifests.select(
        *others, F.posexplode("nodes").alias("position", "node_id", "node")
    ).select(*others, "position", "node_id", "node.*")


def models_only(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("resource_type") == "model")


def exploded_columns(nodes: DataFrame) -> DataFrame:
    """One row per column of a node; nodes without columns give none."""
    others = [name for name in nodes.columns if name != "columns"]
    return nodes.select(*others, F.explode("columns").alias("column_name", "column")).select(
        *others, "column_name", F.col("column.description").alias("column_description")
    )


def ordered_catalog_rows(manifests: DataFrame) -> DataFrame:
    """(source, model_name, column_name, description) of all documented names, plus
    the columns of the document and the node's position in it.

    Models and columns without a description, or with a blank one, are left out; a model
    without a name fails the extraction. The
    model's own entry and those of its columns come from one pass over the documents.
    """
    origin = [*(name for name in manifests.columns if name != "nodes"), "position"]
    unnamed = F.raise_error(F.lit("a documented model has no name"))
    models = models_only(exploded_nodes(manifests)).select(
        *origin,
        F.coalesce("name", unnamed).alias("name"),
        stripped(F.coalesce("description", F.lit(""))).alias("text"),
        F.coalesce(F.map_entries("columns"), F.array()).alias("entries"),
    )
    of_model = F.struct(
        F.lit("model").alias("source"),
        F.col("name").alias("model_name"),
        F.lit(None).cast("string").alias("column_name"),
        F.when(F.col("text") != "", F.col("text")).alias("description"),
    )

    def of_column(entry: Column) -> Column:
        text = stripped(F.coalesce(entry["value"]["description"], F.lit("")))
        label = F.concat(F.col("name"), F.lit("."), entry["key"], F.lit(": "), text)
        return F.struct(
            F.lit("column").alias("source"),
            F.col("name").alias("model_name"),
            entry["key"].alias("column_name"),
            F.when(text != "", label).alias("description"),
        )

    entries = F.concat(F.array(of_model), F.transform("entries", of_column))
    return models.select(*origin, F.inline(entries)).where("description IS NOT NULL")


def catalog_rows(manifests: DataFrame) -> DataFrame:
    return ordered_catalog_rows(manifests).select(*CATALOG_COLUMNS)
