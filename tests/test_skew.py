"""Marts and operators where one key holds a third of all rows, against plain SQL."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketmill.operators.hashing import number_by_hash
from marketmill.operators.latest import latest_per_key
from marketmill.operators.modes import modes_and_means
from marketmill.plans import marts
from tests.plans import final_plan, plan

HOT = "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('{}', pmod(xxhash64(id, {}), {})) END"


def hot(prefix, seed, distinct):
    return HOT.format(prefix, seed, distinct)


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """Orders, payments, customers, items and reviews with gaps, NULLs and hot keys."""
    root = str(tmp_path_factory.mktemp("shop"))
    gaps = "CASE WHEN pmod(xxhash64(id, 9), 11) = 0 THEN NULL ELSE {} END"
    frames = {
        "orders": spark.range(3000).selectExpr(
            "concat('o', id) AS order_id",
            gaps.format(hot("c", 1, 900)) + " AS customer_id",
            "element_at(array('delivered', 'canceled', 'shipped'), "
            "CAST(pmod(xxhash64(id, 2), 3) + 1 AS int)) AS order_status",
            "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(CAST(id % 400 AS int)) "
            "AS order_purchase_timestamp",
        ),
        "payments": spark.range(9000).selectExpr(
            f"CASE WHEN id % 3 = 0 THEN 'o7' ELSE concat('o', pmod(xxhash64(id, 3), 2500)) END "
            "AS order_id",
            "CAST(id * 0.37 AS decimal(10,2)) AS payment_value",
        ),
        "customers": spark.range(1200).selectExpr(
            "CASE WHEN id % 40 = 0 THEN 'hot' ELSE concat('c', id) END AS customer_id",
            hot("u", 4, 100) + " AS customer_unique_id",
        ),
        "sellers": spark.range(60).selectExpr(
            "CASE WHEN id = 0 THEN 'hot' ELSE concat('s', id) END AS seller_id",
            "'city' AS seller_city",
            "'ST' AS seller_state",
        ),
        "items": spark.range(6000).selectExpr(
            hot("s", 5, 50) + " AS seller_id",
            gaps.format("CASE WHEN id % 7 = 0 THEN 'o7' ELSE "
                        "concat('o', pmod(xxhash64(id, 6), 1500)) END") + " AS order_id",
            "CAST(id * 1.13 AS decimal(10,2)) AS price",
            "CAST(id * 0.11 AS decimal(10,2)) AS freight_value",
        ),
        "reviews": spark.range(3000).selectExpr(
            "CASE WHEN id % 50 = 0 THEN 'o7' ELSE concat('o', pmod(xxhash64(id, 7), 3000)) END "
            "AS order_id",
            "CASE WHEN id % 13 = 0 THEN NULL ELSE CAST(id % 5 + 1 AS int) END AS review_score",
        ),
    }
    stored = {}
    for name, df in frames.items():
        df.repartition(6).write.parquet(f"{root}/{name}")
        stored[name] = spark.read.parquet(f"{root}/{name}")
        stored[name].createOrReplaceTempView(f"shop_{name}")
    return stored


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    columns = sorted(left.columns)
    rows = sorted(map(str, left.select(columns).collect()))
    assert rows == sorted(map(str, right.select(columns).collect()))
    return rows


def test_seller_mart(spark, shop):
    found = marts.seller_performance(shop["sellers"], shop["items"], shop["reviews"])
    plain = spark.sql(
        """
        WITH pairs AS (
            SELECT i.*, r.review_score FROM shop_items i
            LEFT JOIN shop_reviews r ON i.order_id = r.order_id),
        figures AS (
            SELECT seller_id, count(DISTINCT order_id) AS n, sum(price) AS p,
                   sum(freight_value) AS f, count(review_score) AS c,
                   CAST(sum(review_score) AS double) / nullif(count(review_score), 0) AS a
            FROM pairs GROUP BY seller_id)
        SELECT s.seller_id, seller_city, seller_state, coalesce(n, 0) AS total_orders,
               coalesce(CAST(p AS decimal(20,2)), 0) AS total_revenue,
               coalesce(CAST(f AS decimal(20,2)), 0) AS total_freight,
               a AS avg_review_score, coalesce(c, 0) AS reviewed_orders
        FROM shop_sellers s LEFT JOIN figures USING (seller_id)"""
    )
    assert len(same(found, plain)) == 60


def test_rows_are_merged_before_the_join(shop):
    """The order that holds a seventh of the items meets 60 reviews as one row each."""
    summary = marts.seller_summary(shop["items"], shop["reviews"])
    text = plan(summary)
    assert text.count("partial_count") >= 3
    assert "Expand" not in text and "CartesianProduct" not in text


def test_marketplace_customer_mart(spark, shop):
    found = marts.marketplace_customer_orders(
        shop["orders"], shop["payments"], shop["customers"]
    )
    plain = spark.sql(
        """
        WITH paid AS (
            SELECT order_id, sum(payment_value) AS amount FROM shop_payments GROUP BY order_id),
        priced AS (
            SELECT o.*, coalesce(CAST(p.amount AS decimal(20,2)), 0.00) AS amount
            FROM shop_orders o LEFT JOIN paid p USING (order_id))
        SELECT customer_unique_id, count(order_id) AS total_orders,
               CAST(sum(amount) AS decimal(20,2)) AS lifetime_value,
               CAST(sum(amount) AS double) / count(amount) AS avg_order_value,
               min(order_purchase_timestamp) AS first_order_date,
               max(order_purchase_timestamp) AS last_order_date,
               count_if(order_status = 'delivered') AS delivered_orders,
               count_if(order_status = 'canceled') AS cancelled_orders
        FROM priced JOIN shop_customers c USING (customer_id) GROUP BY customer_unique_id"""
    )
    assert len(same(found, plain)) > 50


def test_modes(spark, tmp_path):
    rows = spark.range(9000).selectExpr(
        hot("z", 1, 40) + " AS zip",
        "CASE WHEN id % 17 = 0 THEN NULL ELSE concat('city', pmod(xxhash64(id, 2), 300)) END AS city",
        "concat('st', pmod(xxhash64(id, 3), 3)) AS state",
        "CAST(id / 7 AS decimal(18,14)) AS lat",
    )
    path = str(tmp_path / "places")
    rows.repartition(6).write.parquet(path)
    places = spark.read.parquet(path)
    places.createOrReplaceTempView("skewed_places")
    found = modes_and_means(places, "zip", modes=("city", "state"), means=("lat",))

    def mode(column):
        return f"""(SELECT zip, {column} FROM (
            SELECT zip, {column}, row_number() OVER (
                PARTITION BY zip ORDER BY count(*) DESC, {column}) AS place
            FROM skewed_places WHERE {column} IS NOT NULL GROUP BY zip, {column})
            WHERE place = 1)"""

    plain = spark.sql(
        f"""SELECT zip, CAST(sum(lat) AS double) / count(lat) AS lat, c.city, s.state
            FROM skewed_places p LEFT JOIN {mode("city")} c USING (zip)
            LEFT JOIN {mode("state")} s USING (zip)
            GROUP BY zip, c.city, s.state"""
    )
    assert len(same(found, plain)) == 41
    text = plan(found)
    assert "Expand" in text and "Join" not in text and "mode(" not in text


def test_modes_of_a_key_without_values(spark):
    rows = [("a", None, None), ("b", "x", 1), ("b", None, 3), (None, "y", 5)]
    df = spark.createDataFrame(rows, "k string, v string, n int").withColumn(
        "n", F.col("n").cast("decimal(10,2)")
    )
    found = {r["k"]: (r["n"], r["v"]) for r in modes_and_means(df, "k", ["v"], ["n"]).collect()}
    assert found == {"a": (None, None), "b": (2.0, "x"), None: (5.0, "y")}


def test_latest_row_of_a_hot_key(spark):
    df = spark.range(30_000).selectExpr("id", hot("k", 1, 500) + " AS k").repartition(8)
    newest = latest_per_key(df, ["k"], [F.col("id").desc()])
    plain = df.groupBy("k").agg(F.max("id").alias("id"))
    assert len(same(newest, plain)) == 501
    text = final_plan(newest)
    assert text.count("WindowGroupLimit") >= 2  # once before the shuffle, once after


def test_numbering(spark):
    df = spark.range(20_000).selectExpr("concat('k', id) AS k").repartition(8)
    numbered = number_by_hash(df, ["k"], "nr", F.lit(100))
    found = numbered.orderBy("nr").collect()
    assert [r["nr"] for r in found] == list(range(101, 20_101))
    again = number_by_hash(df.repartition(3), ["k"], "nr", F.lit(100))
    assert [r["k"] for r in again.orderBy("nr").collect()] == [r["k"] for r in found]


def test_hot_keys_of_a_join_are_split(spark, shop):
    """The customer id that a thirtieth of the customers and a third of the orders share."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "500",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "100",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        rows = marts.orders_of_customers(
            shop["orders"].hint("merge"), shop["payments"], shop["customers"]
        )
        assert "skew=true" in final_plan(rows)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_and_columns_reach_the_scan(spark, shop):
    mart = marts.marketplace_customer_orders(
        shop["orders"], shop["payments"], shop["customers"]
    )
    text = plan(mart.select("customer_unique_id", "lifetime_value"))
    assert "ReadSchema: struct<order_id:string,payment_value:decimal(10,2)>" in text
    assert "PushedFilters: [IsNotNull(customer_id)]" in text
    assert "order_status" not in text.split("ReadSchema", 1)[1].split("\n", 1)[0]
