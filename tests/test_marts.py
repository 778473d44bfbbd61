"""Gaps and repeats that the sample files do not have, worked out by hand."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marketmill.operators.modes import modes_and_means
from marketmill.plans import marts
from marketmill.session import PARTITION_BYTES, TERABYTE, cluster_conf
from tests.plans import plan

CUSTOMERS = "customer_id bigint, first_name string, last_name string, email string, " \
    "country_code string, created_at date"
ORDERS = "order_id bigint, customer_id bigint, order_date date, status string, " \
    "amount decimal(10,2)"


def rows_by_key(df):
    return {row[0]: tuple(row)[1:] for row in df.collect()}


def test_customer_without_orders_and_order_without_customer(spark):
    customers = spark.createDataFrame(
        [(1, "A", "B", "a@x", "US", date(2024, 1, 1)), (2, "C", "D", "c@x", "CA", None)],
        CUSTOMERS,
    )
    orders = spark.createDataFrame(
        [
            (1, 1, date(2024, 2, 1), "completed", D("10.00")),
            (2, 1, None, "cancelled", None),
            (None, 1, date(2024, 1, 1), "completed", D("5.00")),
            (4, 9, date(2024, 1, 1), "completed", D("7.00")),
            (5, None, date(2024, 1, 1), "completed", D("7.00")),
        ],
        ORDERS,
    )
    found = rows_by_key(
        marts.customer_orders(customers, orders).drop(
            "first_name", "last_name", "email", "country_code", "customer_since"
        )
    )
    assert found == {
        # an order without id is not counted, but its amount and date are used
        1: (2, D("15.00"), 7.5, date(2024, 1, 1), date(2024, 2, 1), 1, 1),
        2: (0, D("0.00"), 0.0, None, None, 0, 0),
    }


def test_unpaid_orders_count_and_unknown_customers_do_not(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "c1", "delivered", datetime(2024, 1, 1)),
            ("o2", "c2", "canceled", datetime(2024, 1, 2)),
            ("o3", "c3", "delivered", datetime(2024, 1, 3)),
            ("o4", None, "delivered", datetime(2024, 1, 4)),
        ],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz",
    )
    payments = spark.createDataFrame(
        [("o1", D("10.00")), ("o1", D("5.50")), ("o3", D("99.00")), ("o9", D("1.00"))],
        "order_id string, payment_value decimal(10,2)",
    )
    customers = spark.createDataFrame(
        [("c1", "u1"), ("c2", "u1"), ("c5", "u5"), (None, "u6")],
        "customer_id string, customer_unique_id string",
    )
    found = rows_by_key(marts.marketplace_customer_orders(orders, payments, customers))
    assert found == {
        "u1": (2, D("15.50"), 7.75, datetime(2024, 1, 1), datetime(2024, 1, 2), 1, 1)
    }


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(
        [("o1", 5), ("o1", 2), ("o2", None), ("o8", 1)], "order_id string, review_score int"
    )


def test_items_count_once_per_review(spark, reviews):
    sellers = spark.createDataFrame(
        [("s1", "x", "SP"), ("s2", "y", "RJ"), ("s3", "z", "BA")],
        "seller_id string, seller_city string, seller_state string",
    )
    items = spark.createDataFrame(
        [
            ("s1", "o1", D("10.00"), D("1.00")),  # two reviews: counted twice
            ("s1", "o1", D("20.00"), D("2.00")),
            ("s1", "o2", D("5.00"), None),  # a review without score
            ("s2", "o3", D("7.00"), D("0.50")),  # no review
            ("s2", None, D("1.00"), D("0.10")),  # no order
            ("s9", "o1", D("1.00"), D("0.10")),  # no such seller
        ],
        "seller_id string, order_id string, price decimal(10,2), freight_value decimal(10,2)",
    )
    found = rows_by_key(
        marts.seller_performance(sellers, items, reviews).drop("seller_city", "seller_state")
    )
    assert found == {
        "s1": (2, D("65.00"), D("6.00"), 3.5, 4),
        "s2": (1, D("8.00"), D("0.60"), None, 0),
        "s3": (0, D("0.00"), D("0.00"), None, 0),
    }
    assert marts.item_reviews(items, reviews).count() == 9


def test_mode_ties_go_to_the_smallest_value(spark):
    places = spark.createDataFrame(
        [("z", "b", 1), ("z", "a", 2), ("z", "c", 3), ("z", "c", 4), ("z", "a", 5), ("y", "q", 6)],
        "zip string, city string, n int",
    )
    found = rows_by_key(modes_and_means(places, "zip", ["city"]))
    assert found == {"z": ("a",), "y": ("q",)}


def test_cluster_shuffles_follow_the_data():
    small, large = cluster_conf(1), cluster_conf(40 * TERABYTE)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) * PARTITION_BYTES == 40 * TERABYTE


def test_items_are_moved_once(spark, tmp_path):
    """One exchange of single items, as narrow rows; reviews, hot orders and sellers are small."""
    frames = {
        "items": spark.range(5000).selectExpr(
            "concat('s', id % 40) AS seller_id",
            "CASE WHEN id % 3 = 0 THEN 'o1' WHEN id % 11 = 0 THEN NULL "
            "ELSE concat('o', id) END AS order_id",
            "CAST(99999999.99 AS decimal(10,2)) AS price",
            "CAST(id % 7 * 0.01 AS decimal(10,2)) AS freight_value",
        ),
        "reviews": spark.range(3000).selectExpr(
            "CASE WHEN id < 500 THEN 'o1' ELSE concat('o', id) END AS order_id",
            "CAST(id % 5 AS int) AS review_score",
        ),
    }
    stored = {}
    for name, df in frames.items():
        df.write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    found = marts.seller_summary(stored["items"], stored["reviews"])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(found)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keyed = [line for line in text.splitlines() if "Arguments: hashpartitioning(order_id" in line]
    assert len(keyed) == 3  # items; reviews per order, and dealt to the items
    assert sum("REPARTITION_BY_COL" in line for line in keyed) == 1
    assert "seller_id" not in "".join(keyed)
    pairs = marts.item_reviews(stored["items"], stored["reviews"])
    plain = pairs.groupBy("seller_id").agg(
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("price").cast("decimal(20,2)").alias("total_revenue"),
        F.sum("freight_value").cast("decimal(20,2)").alias("total_freight"),
        F.try_divide(F.sum("review_score").cast("double"), F.count("review_score")).alias(
            "avg_review_score"
        ),
        F.count("review_score").alias("reviewed_orders"),
    )
    assert found.count() == 40
    assert found.exceptAll(plain).count() == 0 and plain.exceptAll(found).count() == 0


def test_sums_of_money_are_whole_numbers(spark):
    payments = spark.createDataFrame(
        [("o1", D("0.01")), ("o1", D("99999999.99")), ("o2", None), ("o3", D("-0.05"))],
        "order_id string, payment_value decimal(10,2)",
    )
    paid = marts.order_amounts(payments)
    assert paid.schema["amount"].dataType.simpleString() == "decimal(20,2)"
    assert rows_by_key(paid) == {"o1": (D("100000000.00"),), "o2": (None,), "o3": (D("-0.05"),)}
    assert "decimal(20,2)" not in plan(payments.agg(marts.money_sum(payments, "payment_value")))
