"""Tables in parts, and lists of vectors that live on."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketmill.operators.lists import VectorLists
from marketmill.operators.nearest import nearest, nearest_for_each
from marketmill.operators.upsert import upsert
from marketmill.sources.parted import KeyedTable, PartedTable

def newest():
    return [F.col("at").desc()]


def keyed(warehouse, df, buckets=16):
    key = {"k": F.coalesce("k", F.lit(""))}
    return KeyedTable(warehouse, "things", "words", df.schema, key, buckets=buckets)


@pytest.fixture
def words(spark):
    return spark.range(1, 201).selectExpr(
        "id", "concat('key', id) AS k", "CAST(id * 2 AS int) AS v", "1 AS at"
    )


def batch_of(spark, rows):
    return spark.createDataFrame(rows, "id long, k string, v int, at int")


def rows(df):
    return sorted(tuple(row) for row in df.collect())


def test_an_upsert_agrees_with_the_whole_table(spark, warehouse, words):
    table = keyed(warehouse, words)
    table.replace(words)
    batch = batch_of(spark, [(None, "key7", 70, 2), (None, "key7", 71, 3), (None, "new1", 5, 2), (None, "new2", 6, 2), (None, "", 1, 1)])
    want = rows(upsert(words, batch, table.keys, ("v", "at"), "id", newest()))
    table.upsert(batch, ("v", "at"), newest())
    assert rows(table.read()) == want
    again = batch_of(spark, [(None, "new1", 50, 9), (None, "new3", 1, 1)])
    want = rows(upsert(table.read(), again, table.keys, ("v", "at"), "id", newest()))
    table.upsert(again, ("v", "at"), newest())
    assert rows(table.read()) == want and len(want) == 204


def test_one_changed_key_rewrites_one_bucket(spark, warehouse, words):
    table = keyed(warehouse, words)
    table.replace(words)
    before = {f.part: f.location for f in table.parts.folders()}
    assert len(before) == 16
    touched = table.upsert(batch_of(spark, [(None, "key9", -1, 2)]), ("v",), newest())
    after = {f.part: f.location for f in table.parts.folders()}
    assert len(touched) == 1
    assert {part for part in before if before[part] != after[part]} == touched
    written = after[next(iter(touched))]
    assert [name for name in os.listdir(written) if name.startswith("_part")] == [f"_part={next(iter(touched))}"]
    read = set(table.parts.read(touched).inputFiles())
    assert all(f"_part={next(iter(touched))}/" in name for name in read)
    assert table.upsert(words.limit(0), ("v",), newest()) == set()


def test_a_lost_job_leaves_the_old_table(spark, warehouse, words, monkeypatch):
    table = keyed(warehouse, words)
    table.replace(words)
    before = rows(table.read())
    bad = words.limit(3).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        table.upsert(bad, ("v",), newest())
    monkeypatch.setattr(PartedTable, "publish", lambda self, folders: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.upsert(words.withColumn("v", F.lit(0)), ("v",), newest())
    assert rows(table.read()) == before


def test_readers_keep_what_they_have_seen(spark, warehouse, words):
    table = keyed(warehouse, words)
    table.replace(words)
    seen = table.read()
    table.upsert(words.withColumn("v", F.lit(0)), ("v",), newest())
    assert seen.where("v = 0").count() == 0 and table.read().where("v <> 0").count() == 0


def test_wrong_columns_and_buckets_are_refused(spark, warehouse, words):
    table = keyed(warehouse, words)
    table.replace(words)
    with pytest.raises(ValueError, match="columns"):
        table.parts.stage(words.drop("v"), F.lit(0))
    with pytest.raises(ValueError, match="16 buckets, not 8"):
        keyed(warehouse, words, buckets=8).read()
    assert rows(KeyedTable(warehouse, "things", "none", words.schema, table.keys).read()) == []


VECTORS = "id long, name string, embedding array<float>"


def around(rng, center, count, first, spread=0.3):
    return [
        (first + i, f"n{first + i}", (np.array(center) + spread * rng.standard_normal(8)).tolist())
        for i in range(count)
    ]


@pytest.fixture
def lists(spark, warehouse):
    rng = np.random.default_rng(0)
    corpus = [r for i in range(5) for r in around(rng, np.eye(8)[i], 60, 100 * i)]
    corpus += [(900, "none", None), (901, "zero", [0.0] * 8)]
    df = spark.createDataFrame(corpus, VECTORS).repartition(4)
    index = VectorLists(warehouse, "search", "vectors", df.schema)
    index.build(df, lists=5)
    return index


def asked(spark, count=40):
    rng = np.random.default_rng(7)
    found = [(f"q{i}", rng.standard_normal(8).tolist()) for i in range(count)]
    return spark.createDataFrame([*found, ("none", None)], "question_id string, embedding array<float>")


def test_all_lists_are_exact_and_fewer_find_less(spark, lists):
    questions = asked(spark)
    exact = rows(nearest_for_each(lists.rows(), questions, 5))
    assert rows(lists.nearest_for_each(questions, 5, 5)) == exact
    assert rows(lists.nearest_for_each(questions, 9, 5)) == exact
    query = [1.0, 0.2, 0, 0, 0, 0, 0.1, 0]
    assert rows(lists.nearest(query, 5)) == rows(nearest(lists.rows(), query))
    found = lists.recall(questions.where("question_id <> 'none'"), [1, 3, 5]).groupBy("probes").sum("found")
    recalls = [row[1] / 200 for row in found.orderBy("probes").collect()]
    assert recalls == sorted(recalls) and 0.3 < recalls[0] and recalls[-1] == 1.0


def test_probed_lists_only_are_joined(spark, lists):
    few = lists.nearest_for_each(asked(spark, 3), 1)
    assert few.count() == 4 * 5
    named = lists.nearest([1.0] + [0.0] * 7, 1)
    folders = {f"_part={f.part}/" for f in lists.parts.folders()}
    used = {part for part in folders if any(part in name for name in named.inputFiles())}
    assert len(used) == 1


def test_rows_come_change_and_move(spark, lists):
    rng = np.random.default_rng(3)
    before = lists.parts.folders()
    fresh = spark.createDataFrame(around(rng, np.eye(8)[0], 10, 1000), VECTORS)
    assert lists.upsert(fresh, [F.col("name")]) == set()
    kept = {(f.part, f.location) for f in lists.parts.folders()}
    assert {(f.part, f.location) for f in before} < kept
    moved = spark.createDataFrame(
        [(0, "moved", np.eye(8)[4].tolist()), (0, "older", np.eye(8)[3].tolist()), (900, "now usable", np.eye(8)[1].tolist())], VECTORS
    )
    touched = lists.upsert(moved, [F.col("name")])
    assert len(touched) == 2 and -1 in touched
    now = {row["id"]: row for row in lists.rows().collect()}
    assert len(now) == 312 and now[0]["name"] == "moved" and lists.rows().count() == 312
    first = lists.nearest(np.eye(8)[4].tolist(), 1, 1).first()
    assert first["name"] == "moved"
    questions = asked(spark)
    assert rows(lists.nearest_for_each(questions, 5)) == rows(nearest_for_each(lists.rows(), questions))


def test_drift_is_told_and_a_refit_ends_it(spark, lists):
    assert not lists.drifted()
    rng = np.random.default_rng(5)
    lists.upsert(spark.createDataFrame(around(rng, np.eye(8)[7], 400, 2000), VECTORS), [F.col("name")])
    assert lists.drifted()
    lists.refit()
    assert not lists.drifted() and lists.rows().count() == 702
    assert sum(row[2] for row in lists.drift()) == 700
