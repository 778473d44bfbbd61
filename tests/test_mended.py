"""Rebuilt tables, gaps in seed files, catalog updates and sets of questions."""

from __future__ import annotations

import json
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from marketmill.__main__ import ask, embedder
from marketmill.operators.descriptions import ordered_catalog_rows
from marketmill.operators.embed import hashed_words
from marketmill.operators.nearest import nearest_for_each
from marketmill.operators.upsert import upsert
from marketmill.plans.catalog import ensure_catalog, index_catalog, repeated_keys, retrieve
from marketmill.schemas import RAW_COLUMNS, SEED_FILES
from marketmill.sources.csv_files import read_csv_table
from marketmill.sources.tables import Warehouse
from tests.plans import plan


@pytest.mark.parametrize(
    "select",
    ["id, 'x' AS b", "CAST(id AS string) AS id", "'x' AS b, id", "id"],
)
def test_a_rebuilt_table_has_the_new_columns(spark, warehouse, select):
    first = spark.range(3).selectExpr("id", "id AS other")
    warehouse.replace(first, "marts", "t")
    rebuilt = spark.range(2).selectExpr(*select.split(", "))
    warehouse.replace(rebuilt, "marts", "t")
    found = warehouse.read("marts", "t")
    assert found.dtypes == rebuilt.dtypes
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rebuilt.collect()))


def test_a_root_with_a_quote(spark, tmp_path):
    warehouse = Warehouse(spark, f"{tmp_path}/it's", prefix="quote_")
    for rows in (3, 2):
        warehouse.replace(spark.range(rows).toDF("id"), "marts", "t")
    assert warehouse.read("marts", "t").count() == 2
    spark.sql("DROP DATABASE quote_marts CASCADE")


def test_append_refuses_other_columns(spark, warehouse):
    warehouse.replace(spark.range(3).toDF("id"), "marts", "t")
    with pytest.raises(ValueError, match="has columns"):
        warehouse.append(spark.range(3).selectExpr("CAST(id AS string) AS id"), "marts", "t")
    warehouse.append(spark.range(3).toDF("id"), "marts", "t")
    assert warehouse.read("marts", "t").count() == 6


@pytest.mark.parametrize("table", sorted(SEED_FILES.values()))
def test_seed_files_keep_na(spark, tmp_path, table):
    names = [name for name, kind in RAW_COLUMNS[table]]
    texts = [name for name, kind in RAW_COLUMNS[table] if kind == "string"]
    cells = dict.fromkeys(names, "") | dict.fromkeys(texts, "NA")
    (tmp_path / "seed.csv").write_text(f"{','.join(names)}\n{','.join(cells.values())}\n")
    row = read_csv_table(spark, str(tmp_path / "seed.csv"), table).first()
    assert {row[name] for name in texts} == {"NA"}
    assert {row[name] for name in names if name not in texts} <= {None}


def test_a_model_without_a_name_fails(spark):
    node = "struct('model' AS resource_type, CAST(NULL AS string) AS name, 'text' AS description, "
    node += "map('c', struct('d' AS description)) AS columns)"
    manifests = spark.range(1).selectExpr(f"map('n', {node}) AS nodes")
    with pytest.raises(Exception, match="has no name"):
        ordered_catalog_rows(manifests).collect()


def stored_catalog(spark, warehouse, rows):
    """A catalog of `rows` models in the warehouse, with vectors."""
    df = spark.range(1, rows + 1).selectExpr(
        "id",
        "'model' AS source",
        "concat('m', id) AS model_name",
        "CAST(NULL AS string) AS column_name",
        "concat('text ', id) AS description",
        "array_repeat(CAST(id AS float), 64) AS embedding",
        "TIMESTAMP '2024-01-01' AS updated_at",
    )
    ensure_catalog(warehouse)
    warehouse.replace(df, "catalog", "catalog_embeddings")


def test_asking_does_not_move_the_catalog(spark, warehouse):
    stored_catalog(spark, warehouse, 500)
    text = plan(retrieve(ensure_catalog(warehouse), [1.0] * 64))
    assert "TakeOrderedAndProject" in text
    assert "Exchange" not in text and "Window" not in text


def test_indexing_a_small_batch_does_not_move_the_catalog(spark, warehouse, tmp_path, monkeypatch):
    stored_catalog(spark, warehouse, 500)
    seen = []
    replace = Warehouse.replace
    monkeypatch.setattr(
        Warehouse,
        "replace",
        lambda self, df, *names: seen.append(plan(df)) or replace(self, df, *names),
    )
    index_catalog(warehouse, manifest(tmp_path, "m7", "new"), hashed_words, datetime(2024, 6, 1))
    assert len(seen) == 1  # nothing was repeated, so nothing was written but the new catalog
    kept = seen[0]
    assert "BroadcastHashJoin LeftOuter" in kept
    # what is exchanged or sorted comes from the batch, whose rows carry their keys
    for part in re.findall(r"\) (?:Exchange|Sort)\n(Input[^\n]*)\n", kept):
        assert "embedding" not in part or "_key_model_name" in part
    catalog = {r["model_name"]: r for r in ensure_catalog(warehouse).collect()}
    assert len(catalog) == 501 and catalog["new"]["id"] == 501
    assert (catalog["m7"]["id"], catalog["m7"]["description"]) == (7, "about m7")


def manifest(folder, *names):
    nodes = {
        name: {"resource_type": "model", "name": name, "description": f"about {name}"}
        for name in names
    }
    path = folder / "manifests"
    path.mkdir(exist_ok=True)
    (path / "m.json").write_text(json.dumps({"nodes": nodes}))
    return str(path)


def test_repeated_keys_go_once(spark, warehouse, tmp_path):
    stored_catalog(spark, warehouse, 5)
    doubled = ensure_catalog(warehouse)
    more = doubled.withColumn("id", F.col("id") + 5).withColumn("column_name", F.lit(""))
    warehouse.replace(doubled.unionByName(more), "catalog", "catalog_embeddings")
    index_catalog(warehouse, manifest(tmp_path, "m1"), hashed_words, datetime(2024, 6, 1))
    left = ensure_catalog(warehouse)
    assert repeated_keys(left).isEmpty()
    assert sorted(r["id"] for r in left.collect()) == [6, 7, 8, 9, 10]


def test_upsert_moves_each_side_few_times(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 700 AS k", "id AS v")
    rows.write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t")).where("id < 700")
    batch = spark.read.parquet(str(tmp_path / "t")).selectExpr("k + 100 AS k", "v")
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changed = upsert(target, batch, {"k": F.col("k")}, ["v"], "id", [F.col("v").desc()])
        # with the two of the step before (by key: the batch, and the target's keys), six
        assert plan(changed).count("hashpartitioning") <= 4
        found = {r["k"]: (r["id"], r["v"]) for r in changed.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)
    assert len(found) == 800 and found[0] == (0, 0)
    assert found[100] == (100, 700) and found[500] == (500, 400)
    assert sorted(id for id, _ in found.values()) == list(range(800))


def test_upsert_refuses_null_keys(spark):
    target = spark.range(1).selectExpr("id", "'a' AS k", "'x' AS v")
    batch = spark.range(1).selectExpr("CAST(NULL AS string) AS k", "'y' AS v")
    with pytest.raises(Exception, match="NULL among its keys"):
        upsert(target, batch, {"k": F.col("k")}, ["v"], "id", [F.col("v")]).collect()


@pytest.fixture
def vectors(spark):
    df = spark.range(60).selectExpr("id", "array(CAST(id AS float), 1f) AS embedding")
    return df.unionByName(spark.range(60, 62).selectExpr("id", "CAST(NULL AS array<float>) AS embedding"))


def test_no_questions(spark, vectors):
    none = spark.createDataFrame([], "question_id int, embedding array<float>")
    found = nearest_for_each(vectors, none)
    assert found.columns == ["question_id", "rank", "similarity", "id"]
    assert found.count() == 0


@pytest.mark.parametrize("others", [[], [(3, [1.0, 0.0])]])
def test_questions_without_direction(spark, vectors, others):
    asked = [(1, None), (2, [0.0, 0.0]), *others]
    df = spark.createDataFrame(asked, "question_id int, embedding array<float>")
    found = {}
    for row in nearest_for_each(vectors, df, k=3).orderBy("question_id", "rank").collect():
        found.setdefault(row["question_id"], []).append((row["id"], row["similarity"] is None))
    assert found[1] == found[2] == [(0, True), (1, True), (2, True)]
    if others:
        assert found[3] == [(59, False), (58, False), (57, False)]


def test_more_questions_make_more_blocks_but_no_larger_plan(spark, vectors, monkeypatch):
    monkeypatch.setattr("marketmill.operators.nearest.QUESTIONS_PER_BLOCK", 500)
    asked = spark.range(3000).selectExpr("id AS question_id", "array(CAST(id AS float), 50f) AS embedding")
    many = nearest_for_each(vectors, asked, k=1)
    assert {r["question_id"]: r["id"] for r in many.collect()}.keys() == set(range(3000))
    assert many.where("question_id = 1000 AND id = 20").count() == 1
    again = nearest_for_each(vectors, asked, k=1)
    few = nearest_for_each(vectors, asked.limit(3), k=1)
    assert len(plan(again).splitlines()) == len(plan(few).splitlines())


def test_an_empty_catalog_has_no_answer(spark, warehouse, capsys):
    with pytest.raises(SystemExit) as ended:
        ask(warehouse, "anything?", hashed_words, 3)
    assert ended.value.code == 1
    assert "nothing found" in capsys.readouterr().err


def test_the_embedder_is_an_option(spark):
    assert embedder("none") is None
    rows = embedder("tests.test_mended:lengths")(spark.range(1).selectExpr("'four' AS description"))
    assert rows.first()["embedding"] == [4.0]


def lengths(texts):
    return [[float(len(text))] for text in texts]


def test_an_upsert_of_all_keys_leaves_the_target_in_place(spark, tmp_path):
    spark.range(900).selectExpr("id", "id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    batch = spark.range(1000).selectExpr("id AS k", "id + 5 AS v")
    given = (target, batch, {"k": F.col("k")}, ["v"], "id", [F.col("v").desc()])
    whole, plain = upsert(*given, rows=900), upsert(*given)
    assert "LeftOuter" in plan(plain) and "LeftOuter" not in plan(whole)
    found = sorted(map(tuple, whole.where("k < 900").collect()))
    assert found == [(i, i, i + 5) for i in range(900)]
    assert whole.count() == 1000 and whole.select("id").distinct().count() == 1000
    fewer = upsert(target, batch.where("k >= 10"), *given[2:], rows=900)
    assert sorted(r["v"] for r in fewer.where("k < 12").collect()) == [*range(10), 15, 16]
