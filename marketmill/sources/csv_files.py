"""CSV landing files: where they are, how they are read, how they are loaded."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.functions.numbers import rounded_int
from marketmill.functions.text import NULL_TOKENS, SEED_NULL_TOKENS, null_if_token
from marketmill.schemas import MULTI_LINE_TABLES, RAW_COLUMNS, SEED_FILES
from marketmill.sources.quoted_text import RANGE_BYTES, quoted_cells, quoted_records
from marketmill.sources.tables import Warehouse, in_parallel

# Fixed value: folder below a bucket that holds the landing files.
REMOTE_PREFIX = "olist-raw/"

PART_ROWS = 1_000_000


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or pattern is there, on any file system Spark reads."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def missing_files(spark: SparkSession, root: str, names: Iterable[str]) -> list[str]:
    return [name for name in names if not exists(spark, f"{root.rstrip('/')}/{name}")]


def require_files(spark: SparkSession, root: str, names: Iterable[str]) -> None:
    """Fail before anything is written, naming every file that is not there."""
    raise_if_missing(root, missing_files(spark, root, names))


def raise_if_missing(root: str, missing: list[str]) -> None:
    if missing:
        raise FileNotFoundError(f"missing in {root}: {', '.join(missing)}")


def remote_root(bucket: str) -> str:
    """Bucket name (read as `s3a://`) or full address to the landing folder in it."""
    base = bucket if "://" in bucket or bucket.startswith("/") else f"s3a://{bucket}"
    return f"{base.rstrip('/')}/{REMOTE_PREFIX}"


def source_root(
    spark: SparkSession, local: str, names: Iterable[str], bucket: str | None
) -> str:
    """The folder to load from.

    The remote copy is used only when a bucket is set and a file is not there
    locally. Spark reads it in place, so nothing is downloaded first.
    """
    if bucket and missing_files(spark, local, names):
        return remote_root(bucket)
    return local


def typed_cell(name: str, kind: str, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    cell = null_if_token(name, tokens)
    if kind == "string":
        return cell.alias(name)
    if kind == "int":
        return rounded_int(cell).alias(name)
    return cell.cast(kind).alias(name)


def longest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the longest file; only sizes are looked at."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.coalesce(F.max("length"), F.lit(0))).first()[0]


def text_cells(
    spark: SparkSession, path: str, names: list[str], multi_line: bool, range_bytes: int
) -> DataFrame:
    """The cells of CSV files as text. Files with line breaks in quotes are read as a whole
    up to `range_bytes`, longer ones in ranges of that size by as many tasks."""
    if multi_line and longest_file(spark, path) > range_bytes:
        records = quoted_records(spark, path, range_bytes)
        if records is not None:
            return quoted_cells(records, names)
    return (
        spark.read.schema(", ".join(f"{name} string" for name in names))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("multiLine", multi_line)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )


def read_csv_table(
    spark: SparkSession,
    path: str,
    table: str,
    multi_line: bool | None = None,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One landing file (or a folder of parts) with its declared types.

    Cells are read as text, missing-value tokens become NULL and only then is the
    type applied, so `NA` is a gap while `12x` is an error. Seed files know fewer
    tokens: there a country `NA` is a text. Header names must match
    the declared ones, and a row with another number of cells fails the load.
    """
    columns = RAW_COLUMNS[table]
    if multi_line is None:
        multi_line = table in MULTI_LINE_TABLES
    text = text_cells(spark, path, [name for name, _ in columns], multi_line, range_bytes)
    tokens = SEED_NULL_TOKENS if table in SEED_FILES.values() else NULL_TOKENS
    return text.select(*(typed_cell(name, kind, tokens) for name, kind in columns))


def read_csv_tables(
    spark: SparkSession, root: str, files: Mapping[str, str], range_bytes: int = RANGE_BYTES
) -> dict[str, DataFrame]:
    """All landing files as lazy frames; fails like `require_files`.

    Opening a frame lists its files, so a file that is not there shows up here
    without a second listing of those that are.
    """
    frames, missing = {}, []
    for name, table in files.items():
        try:
            path = f"{root.rstrip('/')}/{name}"
            frames[table] = read_csv_table(spark, path, table, range_bytes=range_bytes)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            missing.append(name)
    raise_if_missing(root, missing)
    return frames


def load_csv_tables(
    warehouse: Warehouse,
    root: str,
    files: Mapping[str, str],
    namespace: str = "raw",
    range_bytes: int = RANGE_BYTES,
) -> dict[str, int]:
    """Full reload of all tables; returns `{table: rows}`.

    All files are checked first, all tables are written next, and only when every
    write has succeeded do the table names move to the new data. A rerun therefore
    replaces, and a failed run leaves the previous load in place.
    """
    frames = read_csv_tables(warehouse.spark, root, files, range_bytes)
    warehouse.create_namespace(namespace)
    staged = in_parallel(
        warehouse.spark,
        {
            table: (lambda df=df, table=table: warehouse.stage(df, namespace, table))
            for table, df in frames.items()
        },
    )
    for written in staged.values():
        warehouse.publish(written)
    return {table: written.rows for table, written in staged.items()}


def write_csv_table(df: DataFrame, path: str, compressed: bool = False) -> None:
    """Text form of a table, in the layout `read_csv_table` takes.

    A compressed part is read by one task, so parts hold PART_ROWS rows at most. Tables with
    line breaks in quotes stay plain: they are read in ranges of bytes.
    """
    writer = (
        df.select(*(F.col(name).cast("string").alias(name) for name in df.columns))
        .write.option("header", True)
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
    )
    if compressed:
        writer = (
            writer.option("compression", "gzip")
            .option("zlib.compress.level", "BEST_SPEED")
            .option("maxRecordsPerFile", PART_ROWS)
        )
    writer.csv(path)
