"""Descriptions and questions to vectors."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession

from marketmill.functions.vectors import VECTOR

Embedder = Callable[[list[str]], Sequence[Sequence[float]]]

# Calls per batch and the pauses, in seconds, after failed ones.
ATTEMPTS = 3
PAUSES = (2, 4, 8)

TEXTS_PER_CALL = 256
DIMENSIONS = 64  # of the offline embedder


def hashed_words(
    df: DataFrame, text: str = "description", size: int = DIMENSIONS, output: str = "embedding"
) -> DataFrame:
    """Offline embedder: word counts hashed to `size` places, at length one."""
    words = Tokenizer(inputCol=text, outputCol="_words")
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=size)
    unit = Normalizer(inputCol="_counts", outputCol="_unit")
    staged = unit.transform(counts.transform(words.transform(df)))
    return staged.withColumn(output, vector_to_array("_unit", "float32")).drop(
        "_words", "_counts", "_unit"
    )


def call_with_retry(
    embedder: Embedder,
    texts: list[str],
    retry_on: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
    attempts: int = ATTEMPTS,
    sleep: Callable[[float], None] = time.sleep,
) -> Sequence[Sequence[float]]:
    """Call the embedder; pause and repeat on passing errors, raise the last one."""
    for pause in (*PAUSES[: attempts - 1], None):
        try:
            return embedder(texts)
        except retry_on:
            if pause is None:
                raise
            sleep(pause)
    raise ValueError("attempts must be at least 1")


def embedded(
    df: DataFrame,
    embedder: Embedder,
    text: str = "description",
    output: str = "embedding",
    retry_on: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
    texts_per_call: int = TEXTS_PER_CALL,
) -> DataFrame:
    """`df` with vectors from an outside embedder, one call per slice of a batch.

    A lost task calls again for its texts, so results are written to storage before
    anything else reads them (see `plans.catalog.index_catalog`).
    """
    given = [f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema]
    schema = ", ".join([*given, f"`{output}` {VECTOR}"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, texts_per_call):
                part = batch.slice(start, texts_per_call)
                vectors = call_with_retry(
                    embedder, part.column(text).to_pylist(), retry_on
                )
                if len(vectors) != part.num_rows:
                    raise ValueError("the embedder must return one vector per text")
                values = pa.array(
                    [[float(x) for x in vector] for vector in vectors],
                    pa.list_(pa.float32()),
                )
                yield part.append_column(output, values)

    return df.mapInArrow(run, schema)


def embed_question(
    spark: SparkSession, question: str, embed: Callable[[DataFrame], DataFrame]
) -> list[float]:
    """The vector of one question, by the same embedder as the corpus."""
    asked = spark.createDataFrame([(question,)], "description string")
    return [float(x) for x in embed(asked).first()["embedding"]]
