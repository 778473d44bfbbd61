"""Data tests: a failing row for every kind, and NULLs that pass."""

from __future__ import annotations

import threading

import pytest

from marketmill.checks.damage import damaged
from marketmill.checks.rules import Models
from marketmill.operators.quality import (
    AcceptedValues,
    ExpressionIsTrue,
    NotNull,
    QualityError,
    Relationship,
    Singular,
    Unique,
    assert_all_pass,
    failing_rows,
    key_report,
    orphans,
    quality_report,
    repeated_values,
)
from marketmill.plans.build import MART_NAMESPACES
from tests.plans import plan


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [(1, "a", 5, 1, 1), (2, "b", -1, 2, 3), (2, "c", None, 9, 0), (None, None, 0, 9, 0)],
        "id int, kind string, amount int, parent int, part int",
    ).selectExpr("*", "3 AS whole")
    return {"child": child, "parent": spark.createDataFrame([(1,), (2,)], "key int")}


TESTS = [
    NotNull("child", "id"),
    NotNull("child", "parent"),
    AcceptedValues("child", "kind", ("a", "b")),
    AcceptedValues("child", "amount", (5, -1, 0)),
    ExpressionIsTrue("child", "amount", ">= 0"),
    Unique("child", "id"),
    Unique("child", "kind"),
    Relationship("child", "parent", "parent", "key"),
    Singular("child", "id", "part + amount > whole", ("id", "part")),
    NotNull("parent", "key"),
]


def test_report(spark, tables):
    report = quality_report(spark, tables, TESTS)
    found = {(r["model"], r["column"], r["test"]): r["failures"] for r in report.collect()}
    assert found == {
        ("child", "id", "not_null"): 1,
        ("child", "parent", "not_null"): 0,
        ("child", "kind", "accepted_values"): 1,
        ("child", "amount", "accepted_values"): 0,
        ("child", "amount", "expression_is_true"): 1,
        ("child", "id", "unique"): 1,
        ("child", "kind", "unique"): 0,
        ("child", "parent", "relationships"): 2,
        ("child", "id", "singular"): 1,
        ("parent", "key", "not_null"): 0,
    }
    with pytest.raises(QualityError, match="6 data tests failed"):
        assert_all_pass(report)
    assert_all_pass(report.where("failures = 0"))


def test_failing_rows(tables):
    child = tables["child"]
    assert [r["kind"] for r in failing_rows(TESTS[2], child).collect()] == ["c"]
    assert [r["amount"] for r in failing_rows(TESTS[4], child).collect()] == [-1]
    assert [tuple(r) for r in failing_rows(TESTS[8], child).collect()] == [(1, 1)]
    assert [tuple(r) for r in repeated_values(child, "id").collect()] == [(2, 2)]


def test_tests_of_one_model_share_a_scan(spark, tmp_path):
    from marketmill.operators.quality import row_test_report

    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id", "id AS amount").write.parquet(path)
    tests = [NotNull("t", "id"), NotNull("t", "amount"), ExpressionIsTrue("t", "amount", ">= 0")]
    text = plan(row_test_report(spark.read.parquet(path), tests))
    assert text.count("Scan parquet") == 2  # once in the tree, once in the details


def test_tests_of_one_key_share_a_shuffle(spark, tmp_path):
    for name in ("orders", "items", "payments"):
        spark.range(10).selectExpr("id AS order_id").write.parquet(str(tmp_path / name))
    stored = {
        name: spark.read.parquet(str(tmp_path / name)) for name in ("orders", "items", "payments")
    }
    tests = [
        Unique("orders", "order_id"),
        Relationship("items", "order_id", "orders", "order_id"),
        Relationship("payments", "order_id", "orders", "order_id"),
    ]
    text = plan(key_report(stored, "orders", "order_id", tests))
    assert text.count("Scan parquet") == 2 * 3
    assert text.count("hashpartitioning") == 1 and "Join" not in text


def test_key_without_a_unique_test(spark, tables):
    report = quality_report(spark, tables, [TESTS[7]])
    assert [r["failures"] for r in report.collect()] == [2]
    empty = {name: df.limit(0) for name, df in tables.items()}
    report = quality_report(spark, empty, TESTS)
    assert [r["failures"] for r in report.collect()] == [0] * len(TESTS)


def test_orphans_of_a_hot_key(spark):
    """Two thirds of the rows under two keys, one of them unknown."""
    child = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN 'lost' ELSE concat('k', id) END AS k"
    )
    parent = spark.range(30_000).selectExpr("concat('k', id) AS p").union(
        spark.sql("SELECT 'hot' AS p")
    )
    lost = orphans(child, "k", parent, "p")
    assert [tuple(r) for r in lost.collect()] == [("lost", 10_000)]
    assert "partial_count" in plan(lost)


def test_broken_rows_hash_their_key_once(spark):
    """The hash is a column below the generator, not part of what it makes."""
    df = spark.createDataFrame([("a", "u")], "customer_id string, customer_unique_id string")
    made = damaged("stg_olist_customers", df)
    optimised = made._jdf.queryExecution().optimizedPlan().toString()
    assert optimised.count("md5(") == 1
    assert made.count() > 1


def test_marts_of_a_report_are_stored_side_by_side(spark):
    """Each waits until all have begun; one after the other, the first would break the barrier."""
    begun = threading.Barrier(3, timeout=20)

    class Shop:
        def mart(self, name):
            return name

        def stored(self, df):
            begun.wait()
            return f"stored {df}"

    shop = Shop()
    shop.spark = spark
    models = Models(shop).with_marts(*MART_NAMESPACES)
    assert models == {name: f"stored {name}" for name in MART_NAMESPACES}
