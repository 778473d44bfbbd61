"""Lists of similar vectors that live on: rows come and change, drift is told, recall measured."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from marketmill.functions.vectors import vector_batch
from marketmill.operators.latest import latest_per_key
from marketmill.operators.nearest import (
    LISTS,
    TOP_K,
    UNLISTED,
    best_of_pairs,
    corpus_blocks,
    nearest,
    nearest_for_each,
    question_blocks,
    ranked,
)
from marketmill.session import scratch_path
from marketmill.sources.parted import Folder, PartedTable
from marketmill.sources.tables import Warehouse

LIST, CLOSENESS = "list_id", "closeness"
FALLEN = 0.05  # of the mean closeness to the centres, from which lists have drifted
GROWN = 4.0  # times its share at the fit, from which a list has


@dataclass(frozen=True)
class Center:
    """A list's centre, and its rows and their mean closeness when it was fitted."""

    list_id: int
    vector: tuple[float, ...]
    rows: int
    closeness: float

    def note(self) -> str:
        return json.dumps([self.vector, self.rows, self.closeness])


def closest_lists(targets: np.ndarray, centers: np.ndarray, probes: int) -> np.ndarray:
    """The `probes` closest centres of each row, closest first; of equal ones the lower number."""
    lengths = np.linalg.norm(centers, axis=1)
    products = targets @ (centers / np.where(lengths > 0, lengths, 1)[:, None]).T
    products[:, lengths == 0] = -np.inf
    return np.argsort(-products, axis=1, kind="stable")[:, :probes]


def assigned(df: DataFrame, centers: Sequence[Center], vector: str) -> DataFrame:
    """`df` with the closest list and the cosine to its centre; -1 and null without direction."""
    matrix = np.array([center.vector for center in centers])
    schema = StructType([*df.schema.fields, StructField(LIST, IntegerType()), StructField(CLOSENESS, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1), 1e-300)[:, None]
        for batch in batches:
            lists = np.full(batch.num_rows, UNLISTED, dtype=np.int32)
            cosines = np.full(batch.num_rows, np.nan)
            present, rows = vector_batch(batch.column(vector), matrix.shape[1])
            norms = np.linalg.norm(rows, axis=1)
            usable = norms > 0
            scores = rows[usable] / norms[usable, None] @ unit.T
            lists[present[usable]] = scores.argmax(axis=1)
            cosines[present[usable]] = scores.max(axis=1) if len(scores) else 0
            columns = [pa.array(lists), pa.array(cosines, from_pandas=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[*batch.schema.names, LIST, CLOSENESS]
            )

    return df.mapInArrow(run, schema)


def fitted_centers(corpus: DataFrame, vector: str, lists: int, seed: int) -> np.ndarray:
    values = F.col(vector)
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x)
    usable = corpus.where(values.isNotNull() & (squares > 0))
    features = usable.select(array_to_vector(values).alias("features"))
    model = KMeans(k=lists, distanceMeasure="cosine", featuresCol="features", seed=seed).fit(features)
    return np.array(model.clusterCenters())


class VectorLists:
    """A stored index: rows by list, centres and figures of the fit in its manifest.

    `schema` is that of the rows; ids are unique whole numbers. Readers see an update or a
    refit as a whole.
    """

    def __init__(
        self,
        warehouse: Warehouse,
        namespace: str,
        table: str,
        schema: StructType,
        vector: str = "embedding",
        id_column: str = "id",
    ) -> None:
        extra = [StructField(LIST, IntegerType()), StructField(CLOSENESS, DoubleType())]
        whole = StructType([*schema.fields, *extra])
        self.parts = PartedTable(warehouse, namespace, table, whole, id_column)
        self.vector = vector
        self.id_column = id_column

    def build(self, corpus: DataFrame, lists: int = LISTS, seed: int = 42) -> None:
        """Fit centres to `corpus` and store its rows by list."""
        matrix = fitted_centers(corpus, self.vector, lists, seed)
        bare = [Center(i, tuple(map(float, row)), 0, 0.0) for i, row in enumerate(matrix)]
        rows = assigned(corpus, bare, self.vector)
        staged = self.parts.stage(rows, F.col(LIST))
        means = self.means(self.parts.read_folders(staged))
        known = {f.part: f.rows for f in staged}
        centers = [replace(c, rows=known.get(c.list_id, 0), closeness=means.get(c.list_id, 0.0)) for c in bare]
        self.parts.publish(self.noted(staged, centers))

    @staticmethod
    def noted(folders: list[Folder], centers: Sequence[Center]) -> list[Folder]:
        """The folders, and a row without rows for each centre, which holds it."""
        plain = [f for f in folders if f.location is not None]
        return plain + [Folder(c.list_id, None, 0, None, c.note()) for c in centers]

    @staticmethod
    def centers_of(folders: list[Folder]) -> list[Center]:
        noted = sorted((f.part, *json.loads(f.note)) for f in folders if f.location is None)
        return [Center(i, tuple(vector), rows, closeness) for i, vector, rows, closeness in noted]

    def centers(self) -> list[Center]:
        return self.centers_of(self.parts.folders())

    @staticmethod
    def means(rows: DataFrame) -> dict[int, float]:
        found = rows.groupBy(LIST).agg(F.avg(CLOSENESS)).collect()
        return {list_id: mean for list_id, mean in found if mean is not None}

    def upsert(self, batch: DataFrame, newest_first: Sequence[Column]) -> set[int]:
        """New rows and changed ones, by id; the lists that were written anew.

        A new row is added to its list without rewriting it. A list is rewritten if rows of
        it changed, whether they stay or move. Of batch rows of one id the first in
        `newest_first` order wins.
        """
        folders = self.parts.folders()
        path = scratch_path(batch.sparkSession, "lists-batch")
        newest = latest_per_key(batch, [self.id_column], newest_first).select(*self.row_columns())
        assigned(newest, self.centers_of(folders), self.vector).write.parquet(path)
        rows = batch.sparkSession.read.schema(self.parts.schema).parquet(path)
        ids = rows.select(self.id_column)
        held = self.parts.read_folders(folders).select(self.id_column, LIST)
        changed = held.join(ids, self.id_column, "left_semi").select(LIST).distinct()
        touched = {row[0] for row in changed.collect()}
        kept = self.parts.read_folders(folders, touched).join(ids, self.id_column, "left_anti")
        staged = self.parts.stage(kept.select(*rows.columns).unionByName(rows), F.col(LIST))
        left = [f for f in folders if f.location is None or f.part not in touched]
        self.parts.publish(left + staged)
        return touched

    def row_columns(self) -> list[str]:
        return self.parts.schema.names[:-2]

    def rows(self) -> DataFrame:
        return self.parts.read().select(*self.row_columns())

    def drift(self) -> list[tuple[int, int, int, float, float]]:
        """(list, rows at the fit, rows, mean closeness at the fit, mean closeness) of each list."""
        folders = self.parts.folders()
        now: dict[int, int] = {}
        for f in folders:
            now[f.part] = now.get(f.part, 0) + f.rows
        means = self.means(self.parts.read_folders(folders).select(LIST, CLOSENESS))
        return [
            (c.list_id, c.rows, now.get(c.list_id, 0), c.closeness, means.get(c.list_id, c.closeness))
            for c in self.centers_of(folders)
        ]

    def drifted(self) -> bool:
        """Whether rows have come to lie further from their centres, or one list has outgrown
        the others: by FALLEN of the mean closeness, or GROWN times its share at the fit."""
        lists = self.drift()
        then, now = sum(row[1] for row in lists), sum(row[2] for row in lists)
        if not then or not now:
            return then != now
        close_then = sum(row[1] * row[3] for row in lists) / then
        close_now = sum(row[2] * row[4] for row in lists) / now
        fallen = close_then - close_now > FALLEN * abs(close_then)
        even = 1 / len(lists)
        return fallen or any(n / now > GROWN * max(m / then, even) for _, m, n, _, _ in lists)

    def refit(self, seed: int = 42) -> None:
        """New centres for the rows as they are now."""
        self.build(self.rows(), len(self.centers()), seed)

    def nearest(self, query: Sequence[float], probes: int = 1, k: int = TOP_K) -> DataFrame:
        """`nearest` over the `probes` closest lists; exact if that is all of them."""
        folders = self.parts.folders()
        matrix = np.array([c.vector for c in self.centers_of(folders)])
        chosen = closest_lists(np.asarray([query], dtype=np.float64), matrix, probes)[0].tolist()
        if probes >= len(matrix):
            chosen.append(UNLISTED)
        rows = self.parts.read_folders(folders, chosen).select(*self.row_columns())
        return nearest(rows, query, k, self.vector, self.id_column)

    def nearest_for_each(
        self,
        questions: DataFrame,
        probes: int = 1,
        k: int = TOP_K,
        question_column: str = "question_id",
    ) -> DataFrame:
        """`nearest_for_each` over the `probes` closest lists of every question.

        Each question is copied to its lists; blocks of questions and blocks of a list's
        rows meet in a join on `list_id`. No question passes the driver. Exact if all lists
        are probed.
        """
        folders = self.parts.folders()
        matrix = np.array([c.vector for c in self.centers_of(folders)])
        kind = questions.schema[question_column].dataType.simpleString()
        vectors = questions.schema[self.vector].dataType.simpleString()
        everywhere = [UNLISTED] if probes >= len(matrix) else []

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                targets = np.zeros((batch.num_rows, matrix.shape[1]))
                present, rows = vector_batch(batch.column(1), matrix.shape[1])
                targets[present] = rows
                lists = closest_lists(targets, matrix, probes)
                extra = np.tile(np.array(everywhere, dtype=lists.dtype), (batch.num_rows, 1))
                lists = np.hstack([lists, extra]).astype(np.int32)
                copied = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), lists.shape[1])))
                yield copied.append_column(LIST, pa.array(lists.ravel()))

        asked = questions.select(
            F.col(question_column).alias("question"), F.col(self.vector).alias("vector")
        ).mapInArrow(run, f"question {kind}, vector {vectors}, {LIST} int")
        rows = self.parts.read_folders(folders)
        blocks = corpus_blocks(rows, self.vector, self.id_column, by=LIST)
        pairs = question_blocks(asked, [LIST]).join(blocks, LIST)
        return ranked(best_of_pairs(pairs, k), k, question_column, self.id_column)

    def recall(self, questions: DataFrame, probes: Sequence[int], k: int = TOP_K) -> DataFrame:
        """(question_id, probes, found): how many of the exact `k` hits each number of
        probed lists finds, for every question."""
        path = scratch_path(questions.sparkSession, "exact")
        exact = nearest_for_each(self.rows(), questions, k, self.vector, self.id_column)
        exact.select("question_id", self.id_column).write.parquet(path)
        wanted = questions.sparkSession.read.parquet(path)
        every = None
        for number in probes:
            hits = self.nearest_for_each(questions, number, k).select("question_id", self.id_column)
            hits = hits.withColumns({"hit": F.lit(1), "probes": F.lit(number)})
            every = hits if every is None else every.unionByName(hits)
        numbers = F.explode(F.array(*[F.lit(n) for n in probes])).alias("probes")
        asked = wanted.select("question_id", self.id_column, numbers)
        found = asked.join(every, ["question_id", self.id_column, "probes"], "left")
        return found.groupBy("question_id", "probes").agg(
            F.coalesce(F.sum("hit"), F.lit(0)).cast("int").alias("found")
        )
