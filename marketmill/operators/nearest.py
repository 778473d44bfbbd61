"""Nearest vectors, exactly or through lists of similar ones."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from marketmill.functions.vectors import similarity_to, vector_batch
from marketmill.session import scratch_path

# Hits per question and lists of the approximate index.
TOP_K = 5
LISTS = 10

QUESTIONS_PER_BLOCK = 1024
QUESTIONS_PER_PRODUCT = 256
BLOCK_ROWS = 4096
SHARES = 64  # of the corpus, over which each block of questions is copied


def nearest(
    corpus: DataFrame,
    query: Sequence[float],
    k: int = TOP_K,
    vector: str = "embedding",
    id_column: str = "id",
) -> DataFrame:
    """The `k` rows most similar to one vector, with `similarity`.

    Equal scores go by id; rows without a usable vector come last. Runs as one scan
    with a k-row heap per task. Scoring waits for the vector column alone, so the
    columns of the result are the only others read.
    """
    others = [name for name in corpus.columns if name != vector]
    return (
        corpus.withColumn("similarity", similarity_to(vector, list(query)))
        .orderBy(F.col("similarity").desc_nulls_last(), F.col(id_column))
        .limit(k)
        .select(*others, "similarity")
    )


def nearest_for_each(
    corpus: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    vector: str = "embedding",
    id_column: str = "id",
    question_column: str = "question_id",
) -> DataFrame:
    """(question, rank, similarity, id) of the `k` best rows for every question.

    The corpus is put into blocks where it is read, the questions, stored once, into blocks
    of about QUESTIONS_PER_BLOCK. A block of the corpus meets every block of questions
    through one of SHARES numbers that each question block is copied to: Spark broadcasts
    few questions by their size, and then the corpus does not move; many are joined. No
    question passes the driver. A question whose vector is NULL or has no length gets the
    first `k` ids without similarity, as in `nearest`; without questions there are no rows.
    """
    asked = questions.select(
        F.col(question_column).alias("question"), F.col(vector).alias("vector")
    )
    shares = F.explode(F.sequence(F.lit(0), F.lit(SHARES - 1)))
    groups = question_blocks(asked, []).withColumn("share", shares)
    blocks = corpus_blocks(corpus, vector, id_column)
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SHARES)).cast("int")
    hits = best_of_pairs(groups.join(blocks.withColumn("share", spread), "share"), k)
    return ranked(hits, k, question_column, id_column)


def question_blocks(asked: DataFrame, by: list[str]) -> DataFrame:
    """`by` and questions, targets: blocks of the rows (`by`, question, vector), stored once."""
    path = scratch_path(asked.sparkSession, "questions")
    counted = Observation()
    asked.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    count = max(1, math.ceil(counted.get["rows"] / QUESTIONS_PER_BLOCK))
    stored = asked.sparkSession.read.parquet(path)
    deal = F.pmod(F.xxhash64("question"), F.lit(count)).alias("deal")
    rows = F.collect_list(F.struct("question", "vector")).alias("asked")
    return stored.groupBy(*by, deal).agg(rows).drop("deal")


def corpus_blocks(corpus: DataFrame, vector: str, id_column: str, by: str | None = None) -> DataFrame:
    """ids, vectors (and `by`): up to BLOCK_ROWS rows as one, without a shuffle."""
    kinds = {field.name: field.dataType.simpleString() for field in corpus.schema}
    names = [name for name in (by,) if name]
    schema = ", ".join([*(f"`{name}` {kinds[name]}" for name in names),
                        f"ids array<{kinds[id_column]}>, vectors array<{kinds[vector]}>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = set(range(0, batch.num_rows, BLOCK_ROWS))
            if by:
                batch = batch.sort_by(by)
                ends = pc.run_end_encode(batch.column(2)).run_ends.to_pylist()
                cuts.update(ends[:-1])
            cuts = sorted(cuts)
            offsets = pa.array([*cuts, batch.num_rows], pa.int32())
            arrays = [pa.ListArray.from_arrays(offsets, batch.column(i)) for i in range(2)]
            if by:
                arrays.insert(0, batch.column(2).take(pa.array(cuts)))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "ids", "vectors"])

    chosen = corpus.select(F.col(id_column), F.col(vector), *names)
    return chosen.mapInArrow(run, schema)


def best_of_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """question, id, similarity: the `k` best of each pair (asked; ids, vectors) of blocks."""
    asked = pairs.schema["asked"].dataType.elementType
    kind = asked["question"].dataType.simpleString()
    schema = (
        f"question {kind}, id {pairs.schema['ids'].dataType.elementType.simpleString()}, "
        "similarity double"
    )

    def best(batch: pa.RecordBatch, at: int) -> pa.RecordBatch:
        questions, vectors = batch.column("asked")[at].values.flatten()
        ids, rows = batch.column("ids")[at].values, batch.column("vectors")[at].values
        return best_of_block(questions, vectors, ids, rows, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                yield best(batch, at)
            # Spark fills a batch up to 64 MB: gone before the next is read, and back to the system.
            del batch
            pa.default_memory_pool().release_unused()

    return pairs.select("asked", "ids", "vectors").mapInArrow(run, schema)


def ranked(hits: DataFrame, k: int, question_column: str, id_column: str) -> DataFrame:
    """(question, rank, similarity, id): the `k` best of all hits of a question."""
    best = Window.partitionBy("question").orderBy(
        F.col("similarity").desc_nulls_last(), F.col("id")
    )
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(
            F.col("question").alias(question_column),
            "rank",
            "similarity",
            F.col("id").alias(id_column),
        )
    )


def best_of_block(
    names: pa.Array, vectors: pa.Array, ids: pa.Array, values: pa.Array, k: int
) -> pa.RecordBatch:
    """question, id, similarity: the `k` best rows of a block for each question, as one batch.

    One matrix product scores the block against 256 questions. Its last digits depend on
    where a row lies in the block, so the rows that could be among the best are scored
    again one by one; equal vectors then tie and go by id.
    """
    width = size_of(vectors)
    targets = np.zeros((len(names), width or 0))
    if width:
        given, found = vector_batch(vectors, width)
        targets[given] = found
    lengths = np.sqrt(np.einsum("ij,ij->i", targets, targets))
    unlike = np.flatnonzero(lengths == 0)
    by_id = pc.sort_indices(ids).to_numpy()
    place_of = np.empty(len(ids), dtype=np.int64)  # of each row in the order of ids
    place_of[by_id] = np.arange(len(ids))

    def best(of: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((place_of[of], -scores))[:k]  # rows without a score are last
        return of[order], scores[order]

    first = by_id[:k].astype(np.int64), np.full(min(k, len(ids)), np.nan)
    answers = [first] * len(names)  # to all questions without a direction
    if len(unlike) < len(names):
        present, rows = vector_batch(values, width)
        norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        present, rows, norms = present[norms > 0], rows[norms > 0], norms[norms > 0]
        for start in range(0, len(names), QUESTIONS_PER_PRODUCT):
            part = targets[start : start + QUESTIONS_PER_PRODUCT]
            products = part @ rows.T / norms
            for place, target in enumerate(part, start):
                if lengths[place] == 0:
                    continue
                chosen = could_be_best(products[place - start], lengths[place], k)
                scores = np.einsum("ij,j->i", rows[chosen], target) / (norms[chosen] * lengths[place])
                if len(chosen) >= k:
                    answers[place] = best(present[chosen], scores)
                else:  # too few usable vectors: the others follow them
                    all_ = np.full(len(ids), np.nan)
                    all_[present[chosen]] = scores
                    answers[place] = best(np.arange(len(ids)), all_)
    asked = np.repeat(np.arange(len(names)), [len(found) for found, _ in answers])
    found = np.concatenate([found for found, _ in answers] or [np.empty(0, dtype=np.int64)])
    similarity = np.concatenate([scores for _, scores in answers] or [np.empty(0)])
    return pa.RecordBatch.from_arrays(
        [names.take(pa.array(asked)), ids.take(pa.array(found)), pa.array(similarity, from_pandas=True)],
        names=["question", "id", "similarity"],
    )


def size_of(vectors: pa.Array) -> int | None:
    """The length of the vectors; None if all are NULL."""
    return pc.max(pc.list_value_length(vectors)).as_py()


def could_be_best(products: np.ndarray, length: float, k: int) -> np.ndarray:
    """Rows within rounding distance of the `k` largest products."""
    if products.size <= k:
        return np.arange(products.size)
    bar = np.partition(products, products.size - k)[products.size - k]
    return np.flatnonzero(products >= bar - 1e-9 * max(length, 1.0))


@dataclass(frozen=True)
class ListIndex:
    """Vectors stored by list: `path` is partitioned by `list_id`."""

    path: str
    centers: tuple[tuple[float, ...], ...]


UNLISTED = -1  # rows without a usable vector belong to no list


def build_lists(
    corpus: DataFrame,
    path: str,
    lists: int = LISTS,
    vector: str = "embedding",
    seed: int = 42,
) -> ListIndex:
    """Cluster by direction and store each cluster as one partition folder.

    Lists are as uneven as the data. They are rebalanced for the write: a list that
    holds a third of the rows is split over many tasks, small ones are merged.
    """
    values = F.col(vector)
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    usable = values.isNotNull() & (squares > 0)
    listed = corpus.where(usable).withColumn("_features", array_to_vector(values))
    model = KMeans(
        k=lists, distanceMeasure="cosine", featuresCol="_features", seed=seed
    ).setPredictionCol("list_id").fit(listed)
    assigned = model.transform(listed).drop("_features")
    rest = corpus.where(~F.coalesce(usable, F.lit(False))).withColumn(
        "list_id", F.lit(UNLISTED)
    )
    (
        assigned.unionByName(rest)
        .hint("rebalance", "list_id")
        .write.mode("overwrite")
        .partitionBy("list_id")
        .parquet(path)
    )
    return ListIndex(path, tuple(tuple(map(float, c)) for c in model.clusterCenters()))


def nearest_in_lists(
    spark: SparkSession,
    index: ListIndex,
    query: Sequence[float],
    probes: int = 1,
    k: int = TOP_K,
    vector: str = "embedding",
    id_column: str = "id",
) -> DataFrame:
    """`nearest` over the `probes` closest lists; other folders are not read.

    Approximate unless all lists are probed, which gives the exact answer.
    """
    target = np.asarray(query, dtype=np.float64)

    def closeness(center: tuple[float, ...]) -> float:
        length = math.dist(center, [0.0] * len(center))
        return float(target @ np.asarray(center)) / length if length else -math.inf

    ranked = sorted(
        range(len(index.centers)), key=lambda i: (-closeness(index.centers[i]), i)
    )
    chosen = ranked[:probes]
    if len(chosen) == len(index.centers):
        chosen.append(UNLISTED)
    corpus = spark.read.parquet(index.path).where(F.col("list_id").isin(chosen))
    return nearest(corpus.drop("list_id"), query, k, vector, id_column)
