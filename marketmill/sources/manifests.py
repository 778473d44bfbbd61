"""Nested JSON catalog documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.schemas import MANIFEST_SCHEMA
from marketmill.sources.csv_files import exists


def read_manifests(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per document: `manifest` (the file it came from) and `nodes`.

    `path` may be one file or a folder with one document per project or day. Pretty
    printed documents need `multi_line`; with one document per line the files can
    also be split between tasks. Keys that are not part of the schema are skipped
    while parsing.
    """
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} not found: build the documents first")
    return (
        spark.read.schema(MANIFEST_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST")
        .json(path)
        .select(F.col("_metadata.file_path").alias("manifest"), "nodes")
    )
