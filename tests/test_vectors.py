"""Nearest vectors against numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketmill.functions.vectors import checked_vector, cosine_similarity
from marketmill.operators.nearest import (
    best_of_block,
    best_of_pairs,
    build_lists,
    nearest,
    nearest_for_each,
    nearest_in_lists,
)
from tests.plans import plan

DIMENSIONS = 16


def corpus_rows(count=400, seed=1):
    """A third of the vectors are the same; some are missing, some have no length."""
    rng = np.random.default_rng(seed)
    vectors = rng.normal(size=(count, DIMENSIONS)).astype(np.float32)
    vectors[::3] = vectors[0]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows[7] = (7, None)
    rows[8] = (8, [0.0] * DIMENSIONS)
    return rows


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame(corpus_rows(), "id bigint, embedding array<float>").repartition(
        6
    )


def similarity(a, b):
    if a is None or not any(a):
        return None
    a, b = np.asarray(a), np.asarray(b)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def expected(query, k):
    scored = [(similarity(v, query), i) for i, v in corpus_rows()]
    scored.sort(key=lambda found: (found[0] is None, -round(found[0] or 0, 12), found[1]))
    return [i for _, i in scored[:k]]


@pytest.mark.parametrize("k", [1, 5, 150, 400])
def test_nearest(corpus, k):
    query = corpus_rows()[0][1]
    assert [r["id"] for r in nearest(corpus, query, k).collect()] == expected(query, k)


def test_unusable_vectors_come_last_without_a_score(corpus):
    last = nearest(corpus, corpus_rows()[1][1], 400).collect()[-2:]
    assert [(r["id"], r["similarity"]) for r in last] == [(7, None), (8, None)]


def test_nearest_is_one_top_k_over_two_columns(spark, tmp_path, corpus):
    path = str(tmp_path / "corpus")
    corpus.withColumn("other", F.lit("x" * 100)).write.parquet(path)
    stored = spark.read.parquet(path).select("id", "embedding")
    text = plan(nearest(stored, corpus_rows()[0][1]))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "ReadSchema: struct<id:bigint,embedding:array<float>>" in text


@pytest.mark.parametrize("questions", [3, 300])
def test_nearest_for_each(spark, corpus, questions):
    asked = corpus_rows(400, seed=2)[-questions:]
    asked = [(f"q{i}", v) for i, v in asked if v and any(v)]
    df = spark.createDataFrame(asked, "question_id string, embedding array<float>")
    found = {}
    answers = nearest_for_each(corpus, df, k=4)
    for row in answers.orderBy("question_id", "rank").collect():
        found.setdefault(row["question_id"], []).append(row["id"])
    assert found == {name: expected(vector, 4) for name, vector in asked}
    text = plan(answers)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_nearest_for_each_with_fewer_usable_rows_than_k(spark, corpus):
    few = corpus.where("id IN (7, 8, 9)")
    asked = spark.createDataFrame([(1, corpus_rows()[9][1])], "question_id int, embedding array<float>")
    rows = nearest_for_each(few, asked, k=5).orderBy("rank").collect()
    assert [(r["id"], r["similarity"] is None) for r in rows] == [
        (9, False),
        (7, True),
        (8, True),
    ]


def test_wrong_size_fails(corpus):
    with pytest.raises(Exception, match="does not have 3 dimensions"):
        nearest(corpus, [1.0, 2.0, 3.0]).collect()
    with pytest.raises(Exception, match="expected 3 dimensions, not 16"):
        corpus.select(checked_vector("embedding", 3)).collect()
    assert corpus.select(checked_vector("embedding", DIMENSIONS)).count() == 400


def test_expression_agrees_with_the_batch_form(spark, corpus):
    query = corpus_rows()[1][1]
    literal = F.lit(query).cast("array<float>")
    by_expression = {
        r["id"]: r["s"]
        for r in corpus.select("id", cosine_similarity("embedding", literal).alias("s")).collect()
    }
    for row in nearest(corpus, query, 400).collect():
        if row["similarity"] is None:
            assert by_expression[row["id"]] is None
        else:
            assert row["similarity"] == pytest.approx(by_expression[row["id"]], abs=1e-12)


@pytest.fixture(scope="module")
def lists(spark, corpus, tmp_path_factory):
    return build_lists(corpus, str(tmp_path_factory.mktemp("lists") / "index"), lists=5)


def test_all_lists_give_the_exact_answer(spark, corpus, lists):
    assert spark.read.parquet(lists.path).count() == 400
    query = corpus_rows()[1][1]
    found = nearest_in_lists(spark, lists, query, probes=5, k=400)
    assert [r["id"] for r in found.collect()] == expected(query, 400)


def test_more_lists_find_more(spark, corpus, lists):
    recalls = []
    for probes in (1, 3, 5):
        hits = 0
        for place in (1, 2, 4, 5, 10, 11):
            query = corpus_rows()[place][1]
            found = nearest_in_lists(spark, lists, query, probes=probes, k=5).collect()
            hits += len({r["id"] for r in found} & set(expected(query, 5)))
        recalls.append(hits / 30)
    assert recalls == sorted(recalls) and recalls[0] > 0.2 and recalls[-1] == 1.0


def test_other_lists_are_not_read(spark, corpus, lists):
    text = plan(nearest_in_lists(spark, lists, corpus_rows()[1][1], probes=1))
    assert "PartitionFilters: [isnotnull(list_id" in text or "PartitionFilters: [list_id" in text


def test_questions_do_not_pass_the_driver(spark, corpus, monkeypatch):
    asked = spark.createDataFrame(
        [(i, v) for i, v in corpus_rows(60, seed=3) if v], "question_id int, embedding array<float>"
    )
    monkeypatch.setattr("marketmill.operators.nearest.QUESTIONS_PER_BLOCK", 7)
    monkeypatch.setattr("marketmill.operators.nearest.BLOCK_ROWS", 11)
    with monkeypatch.context() as patched:
        for name in ("collect", "toArrow", "toPandas", "toLocalIterator", "first", "take", "head"):
            patched.setattr(type(corpus), name, None)
        answers = nearest_for_each(corpus, asked, k=3)
    found = {}
    for row in answers.orderBy("question_id", "rank").collect():
        found.setdefault(row["question_id"], []).append(row["id"])
    vectors = dict(corpus_rows(60, seed=3))
    assert found.keys() == {i for i, v in vectors.items() if v}
    for name, hits in found.items():
        assert hits == (expected(vectors[name], 3) if any(vectors[name]) else [0, 1, 2])


def test_a_pair_of_blocks_is_answered_in_one_batch():
    """Not a batch for each question; rows without a direction, ties and NULL ids as before."""
    questions = pa.array([7, 8, 9])
    vectors = pa.array([[1.0, 0.0], None, [0.0, 0.0]], pa.list_(pa.float32()))
    ids = pa.array([5, 4, None, 1])
    values = pa.array([[2.0, 0.0], [1.0, 0.0], [0.0, 1.0], None], pa.list_(pa.float32()))
    found = best_of_block(questions, vectors, ids, values, 2)
    assert isinstance(found, pa.RecordBatch)
    assert list(zip(*found.to_pydict().values(), strict=True)) == [
        (7, 4, 1.0), (7, 5, 1.0), (8, 1, None), (8, 4, None), (9, 1, None), (9, 4, None)
    ]
    whole = best_of_block(questions.slice(0, 1), vectors.slice(0, 1), ids, values, 9)
    assert whole.to_pydict()["id"] == [4, 5, None, 1]
    assert whole.to_pydict()["similarity"] == [1.0, 1.0, 0.0, None]


def test_a_batch_of_pairs_is_given_back_before_the_next(spark):
    kinds = pa.struct([("question", pa.int64()), ("vector", pa.list_(pa.float32()))])
    held = []

    class Pairs:
        """Stands for the joined rows: hands the function of the tasks over."""

        schema = StructType.fromDDL(
            "asked array<struct<question: bigint, vector: array<float>>>, "
            "ids array<bigint>, vectors array<array<float>>"
        )

        def select(self, *_):
            return self

        def mapInArrow(self, run, _):
            return run

    def batches():
        for _ in range(3):
            asked = pa.array([[{"question": 1, "vector": [1.0, 0.0]}]], pa.list_(kinds))
            ids = pa.array([list(range(50_000))], pa.list_(pa.int64()))
            vectors = pa.array([[[1.0, 2.0]] * 50_000], pa.list_(pa.list_(pa.float32())))
            made = [pa.RecordBatch.from_arrays([asked, ids, vectors], names=["asked", "ids", "vectors"])]
            del asked, ids, vectors
            yield made.pop()
            held.append(pa.total_allocated_bytes())

    before = pa.total_allocated_bytes()
    assert sum(found.num_rows for found in best_of_pairs(Pairs(), 5)(batches())) == 15
    assert max(held) - before < 100_000
