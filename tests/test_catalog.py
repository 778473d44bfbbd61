"""Catalog documents, updates by key and retrieval text."""

from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketmill.functions.vectors import parse_vector
from marketmill.operators.descriptions import catalog_rows
from marketmill.operators.embed import (
    call_with_retry,
    embed_question,
    embedded,
    hashed_words,
)
from marketmill.operators.upsert import without
from marketmill.plans.catalog import (
    CATALOG_SCHEMA,
    context,
    deduplicated,
    embedded_by_digest,
    ensure_catalog,
    index_catalog,
    retrieve,
    upserted,
)
from marketmill.sources.manifests import read_manifests
from tests.plans import plan

RUN_AT = datetime(2024, 6, 1)

DOCUMENT = {
    "metadata": {"version": 12},
    "nodes": {
        "model.shop.customers": {
            "resource_type": "model",
            "name": "customers",
            "description": "\n Known customers.\t",
            "tags": ["a"],
            "columns": {
                "customer_id": {"name": "customer_id", "description": "Key. "},
                "email": {"description": "  "},
                "city": {},
            },
        },
        "model.shop.bare": {"resource_type": "model", "name": "bare"},
        "test.shop.not_null": {
            "resource_type": "test",
            "name": "not_null",
            "description": "A test.",
        },
    },
}


def documents(folder, *contents):
    folder.mkdir(exist_ok=True)
    for place, content in enumerate(contents):
        (folder / f"m{place}.json").write_text(json.dumps(content, indent=2))
    return str(folder)


def test_extraction(spark, tmp_path):
    path = documents(tmp_path / "m", DOCUMENT)
    found = sorted(map(tuple, catalog_rows(read_manifests(spark, path)).collect()))
    assert found == [
        ("column", "customers", "customer_id", "customers.customer_id: Key."),
        ("model", "customers", None, "Known customers."),
    ]


def test_empty_document(spark, tmp_path):
    path = documents(tmp_path / "m", {"nodes": {}}, {})
    assert catalog_rows(read_manifests(spark, path)).count() == 0


def test_missing_documents(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_manifests(spark, str(tmp_path / "none"))


def batch_of(spark, *rows):
    """Rows (order, source, model, column, description)."""
    df = spark.createDataFrame(
        list(rows),
        "nr int, source string, model_name string, column_name string, description string",
    )
    return df.select(
        "*",
        F.array(F.col("nr").cast("float")).alias("embedding"),
        F.lit(RUN_AT).alias("updated_at"),
    )


def test_upsert_keeps_ids_and_last_of_batch_wins(spark):
    empty = spark.createDataFrame([], CATALOG_SCHEMA)
    order = [F.col("nr").desc()]
    first = upserted(
        empty,
        batch_of(
            spark,
            (1, "column", "m", "c", "first"),
            (2, "model", "m", None, "first model"),
            (3, "column", "m", "c", "second"),
            (4, "model", "m", None, "second model"),
        ),
        order,
    )
    rows = {(r["source"], r["model_name"]): r for r in first.collect()}
    assert {k: r["description"] for k, r in rows.items()} == {
        ("column", "m"): "second",
        ("model", "m"): "second model",
    }
    assert sorted(r["id"] for r in rows.values()) == [1, 2]

    second = upserted(
        first,
        batch_of(
            spark,
            (1, "model", "m", "", "the empty name is the same key"),
            (2, "model", "n", None, "new"),
            (3, "column", "m", "d", "new"),
        ),
        order,
    )
    after = {(r["source"], r["model_name"], r["column_name"]): r for r in second.collect()}
    assert set(after) == {
        ("column", "m", "c"),
        ("column", "m", "d"),
        ("model", "m", None),
        ("model", "n", None),
    }
    assert after["model", "m", None]["id"] == rows["model", "m"]["id"]
    assert after["model", "m", None]["description"] == "the empty name is the same key"
    assert after["column", "m", "c"]["description"] == "second"
    assert sorted(r["id"] for r in after.values()) == [1, 2, 3, 4]


def test_upsert_can_write_nulls(spark):
    target = upserted(
        spark.createDataFrame([], CATALOG_SCHEMA),
        batch_of(spark, (1, "model", "m", None, "text")),
        [F.col("nr").desc()],
    )
    batch = batch_of(spark, (1, "model", "m", None, "text")).withColumn(
        "embedding", F.lit(None).cast("array<float>")
    )
    assert upserted(target, batch, [F.col("nr").desc()]).first()["embedding"] is None


def test_upsert_of_a_small_batch_does_not_move_the_target(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.range(1000).selectExpr(
        "id",
        "'model' AS source",
        "concat('m', id) AS model_name",
        "CAST(NULL AS string) AS column_name",
        "'text' AS description",
        "array(1f) AS embedding",
        "TIMESTAMP '2024-01-01' AS updated_at",
    ).write.parquet(path)
    batch = str(tmp_path / "batch")
    batch_of(spark, (1, "model", "m5", None, "changed")).write.parquet(batch)
    changed = upserted(spark.read.parquet(path), spark.read.parquet(batch), [F.col("nr").desc()])
    assert changed.where("description = 'changed'").count() == 1
    text = plan(changed)
    assert "BroadcastHashJoin LeftOuter" in text
    # the other read of the target takes its ids only; its keys were compared beforehand
    assert "ReadSchema: struct<id:bigint>" in text


def test_dedupe_prefers_missing_time_then_newer_then_higher_id(spark):
    rows = [
        (1, "a", datetime(2024, 1, 1)),
        (2, "a", datetime(2024, 1, 2)),
        (3, "a", datetime(2024, 1, 2)),
        (4, "b", None),
        (5, "b", datetime(2024, 1, 2)),
    ]
    df = spark.createDataFrame(rows, "id bigint, model_name string, updated_at timestamp")
    df = df.selectExpr("*", "'model' AS source", "CAST(NULL AS string) AS column_name")
    kept = deduplicated(df)
    assert sorted(r["id"] for r in kept.collect()) == [3, 4]
    assert "WindowGroupLimit" in plan(kept)


def test_delete_keeps_rows_it_knows_nothing_about(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, name string")
    assert sorted(r["id"] for r in without(df, F.col("name") == "a").collect()) == [2, 3]


def test_index_twice(spark, warehouse, tmp_path):
    path = documents(tmp_path / "m", DOCUMENT)
    assert index_catalog(warehouse, path, None, RUN_AT) == {"stored": 0, "skipped": 2}
    assert index_catalog(warehouse, path, hashed_words, RUN_AT) == {"stored": 2, "skipped": 0}
    first = {r["source"]: r for r in ensure_catalog(warehouse).collect()}

    changed = json.loads(json.dumps(DOCUMENT))
    changed["nodes"]["model.shop.customers"]["description"] = "All customers."
    # a second project documents the model of the same name: the later file wins
    later = {
        "nodes": {
            "x": {"resource_type": "model", "name": "customers", "description": "Later file."}
        }
    }
    documents(tmp_path / "m", changed, later)
    assert index_catalog(warehouse, path, hashed_words, datetime(2024, 6, 2))["stored"] == 3
    second = {r["source"]: r for r in ensure_catalog(warehouse).collect()}
    assert {k: r["id"] for k, r in second.items()} == {k: r["id"] for k, r in first.items()}
    assert second["model"]["description"] == "Later file."
    assert second["model"]["updated_at"] == datetime(2024, 6, 2)


def test_vectors_of_another_size_are_refused(spark, warehouse, tmp_path):
    path = documents(tmp_path / "m", DOCUMENT)
    with pytest.raises(Exception, match="expected 32 dimensions, not 64"):
        index_catalog(warehouse, path, hashed_words, RUN_AT, size=32)
    assert ensure_catalog(warehouse).count() == 0


def test_question_finds_its_text(spark, warehouse, tmp_path):
    path = documents(tmp_path / "m", DOCUMENT)
    index_catalog(warehouse, path, hashed_words, RUN_AT)
    vector = embed_question(spark, "known customers.", hashed_words)
    hits = retrieve(ensure_catalog(warehouse), vector, k=1).collect()
    assert hits[0]["description"] == "Known customers."
    assert hits[0]["similarity"] == pytest.approx(1.0)


def test_context_lines(spark):
    hits = spark.createDataFrame(
        [
            (1, 2, "model", "m", None, "the model"),
            (1, 1, "column", "m", "c", "m.c: the column"),
            (2, 1, "model", "n", "", "other"),
        ],
        "question_id int, rank int, source string, model_name string, column_name string, "
        "description string",
    )
    found = {r["question_id"]: r["context"] for r in context(hits, "question_id").collect()}
    assert found == {
        1: "- [column] m.c: m.c: the column\n- [model] m: the model",
        2: "- [model] n: other",
    }


def test_vector_text(spark):
    df = spark.createDataFrame([("[0.5, -1, 2e0]",), (None,)], "v string")
    assert [r[0] for r in df.select(parse_vector("v")).collect()] == [[0.5, -1.0, 2.0], None]


class Flaky:
    def __init__(self, failures, error=ConnectionError):
        self.left, self.error, self.calls = failures, error, 0

    def __call__(self, texts):
        self.calls += 1
        if self.left:
            self.left -= 1
            raise self.error("busy")
        return [[1.0] for _ in texts]


def test_retry():
    slept = []
    embedder = Flaky(2)
    assert call_with_retry(embedder, ["a"], sleep=slept.append) == [[1.0]]
    assert (embedder.calls, slept) == (3, [2, 4])

    embedder = Flaky(3)
    with pytest.raises(ConnectionError):
        call_with_retry(embedder, ["a"], sleep=slept.append)
    assert embedder.calls == 3

    embedder = Flaky(1, ValueError)
    with pytest.raises(ValueError):
        call_with_retry(embedder, ["a"], sleep=slept.append)
    assert embedder.calls == 1


def test_outside_embedder_sees_every_text_once(spark):
    df = spark.range(1000).selectExpr("id", "concat('text ', id) AS description")
    vectors = embedded(
        df, lambda texts: [[float(t.split()[1]), 1.0] for t in texts], texts_per_call=7
    )
    assert vectors.where("embedding[0] = id AND size(embedding) = 2").count() == 1000


def test_outside_embedder_must_answer_in_full(spark):
    df = spark.range(3).coalesce(1).selectExpr("concat('t', id) AS description")
    with pytest.raises(Exception, match="one vector per text"):
        embedded(df, lambda texts: [[1.0]]).collect()


class Counting:
    """An embedder that notes the texts it is given, and fails in one of its runs."""

    def __init__(self, fails_in=None):
        self.seen = []
        self.fails_in = fails_in

    def __call__(self, rows):
        if self.fails_in == len(self.seen):
            raise ConnectionError("cut off")
        self.seen.append(sorted(row["description"] for row in rows.select("description").collect()))
        return hashed_words(rows)


def described(spark, count, changed=()):
    return spark.createDataFrame(
        [(f"m{i}", f"text {i % 30}{' new' if i in changed else ''}") for i in range(count)],
        "model_name string, description string",
    )


def test_known_texts_are_not_embedded_again(spark, warehouse):
    first = Counting()
    found = embedded_by_digest(warehouse, described(spark, 40), first, "words").collect()
    assert len(found) == 40 and len(first.seen) == 1 and len(first.seen[0]) == 30
    again = Counting()
    same = embedded_by_digest(warehouse, described(spark, 40), again, "words").collect()
    assert again.seen == [] and sorted(map(str, same)) == sorted(map(str, found))
    embedded_by_digest(warehouse, described(spark, 40, {3, 5}), again, "words").collect()
    assert again.seen == [["text 3 new", "text 5 new"]]
    other = Counting()
    embedded_by_digest(warehouse, described(spark, 40), other, "another embedder").collect()
    assert len(other.seen) == 1
    with pytest.raises(Exception, match="expected 32 dimensions"):
        embedded_by_digest(warehouse, described(spark, 40), again, "words", size=32).collect()


def test_a_run_that_was_cut_off_goes_on(spark, warehouse):
    cut = Counting(fails_in=2)
    with pytest.raises(ConnectionError):
        embedded_by_digest(warehouse, described(spark, 30), cut, "words", texts_per_run=8)
    rest = Counting()
    found = embedded_by_digest(warehouse, described(spark, 30), rest, "words", texts_per_run=100)
    assert found.count() == 30
    texts = [text for seen in (*cut.seen, *rest.seen) for text in seen]
    assert len(cut.seen) == 2 and sorted(texts) == sorted({f"text {i}" for i in range(30)})


def test_indexing_twice_embeds_once(spark, warehouse, tmp_path):
    path = documents(tmp_path / "m", DOCUMENT)
    first, second = Counting(), Counting()
    one = index_catalog(warehouse, path, first, RUN_AT)
    assert index_catalog(warehouse, path, second, RUN_AT) == one
    assert len(first.seen) == 1 and second.seen == []
    missing = Counting()
    rows = embedded_by_digest(warehouse, described(spark, 1).limit(0), missing, "default")
    assert rows.count() == 0 and missing.seen == []
