"""Staging tables, marts and the steps they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.checks.inputs import Given, event_catalog
from marketmill.checks.registry import check, columns_sql
from marketmill.functions.numbers import mean_of
from marketmill.operators.latest import latest_per_key
from marketmill.operators.modes import modes_and_means
from marketmill.operators.quality import repeated_values
from marketmill.plans import marts

MODEL_SQL = {
    "stg_customers": columns_sql(
        "stg_customers", "customer_id first_name last_name email country_code", "", "created_at"
    ),
    "stg_orders": columns_sql(
        "stg_orders", "order_id customer_id status", "amount", "order_date"
    ),
    "stg_olist_customers": "SELECT * FROM stg_olist_customers",
    "stg_olist_orders": columns_sql(
        "stg_olist_orders",
        "order_id customer_id order_status",
        "",
        "order_purchase_timestamp order_approved_at order_delivered_carrier_date "
        "order_delivered_customer_date order_estimated_delivery_date",
    ),
    "stg_olist_order_items": columns_sql(
        "stg_olist_order_items",
        "order_id order_item_id product_id seller_id",
        "price freight_value",
        "shipping_limit_date",
    ),
    "stg_olist_order_payments": columns_sql(
        "stg_olist_order_payments",
        "order_id payment_sequential payment_type payment_installments",
        "payment_value",
    ),
    "stg_olist_order_reviews": columns_sql(
        "stg_olist_order_reviews",
        "review_id order_id review_comment_title review_comment_message",
        "review_score",
        "review_creation_date review_answer_timestamp",
    ),
    "stg_olist_products": columns_sql(
        "stg_olist_products",
        "product_id product_category_name product_name_length product_photos_qty",
        "product_description_length product_weight_g product_length_cm product_height_cm product_width_cm",
    ),
    "stg_olist_sellers": "SELECT * FROM stg_olist_sellers",
    "stg_olist_product_category_translation": (
        "SELECT * FROM stg_olist_product_category_translation"
    ),
    "mart_customer_orders": columns_sql(
        "mart_customer_orders",
        "customer_id first_name last_name email country_code total_orders completed_orders "
        "cancelled_orders avg_order_value",
        "lifetime_value",
        "customer_since first_order_date last_order_date",
    ),
    "mart_customer_orders_masked": columns_sql(
        "mart_customer_orders_masked",
        "customer_id email total_orders completed_orders cancelled_orders",
        "lifetime_value",
    ),
    "mart_olist_customer_orders": columns_sql(
        "mart_olist_customer_orders",
        "customer_unique_id total_orders avg_order_value delivered_orders cancelled_orders",
        "lifetime_value",
        "first_order_date last_order_date",
    ),
    "mart_olist_seller_performance": columns_sql(
        "mart_olist_seller_performance",
        "seller_id seller_city seller_state total_orders avg_review_score reviewed_orders",
        "total_revenue total_freight",
    ),
}

GAPS = ("review_score", "product_description_length")

for _model, _sql in MODEL_SQL.items():
    check(_model, _sql, GAPS)(lambda given, _model=_model: given.model(_model))


@check(
    "stg_olist_geolocation",
    """SELECT geolocation_zip_code_prefix, round(geolocation_lat, 6) AS geolocation_lat,
              round(geolocation_lng, 6) AS geolocation_lng, geolocation_city, geolocation_state
       FROM stg_olist_geolocation""",
)
def stg_olist_geolocation(given: Given) -> DataFrame:
    return given.staged("stg_olist_geolocation").withColumns(
        {
            "geolocation_lat": F.round("geolocation_lat", 6),
            "geolocation_lng": F.round("geolocation_lng", 6),
        }
    )


@check("proj_subset_masked", MODEL_SQL["mart_customer_orders_masked"])
def proj_subset_masked(given: Given) -> DataFrame:
    return marts.customer_orders_masked(given.mart("mart_customer_orders"))


@check(
    "proj_coalesce_defaults",
    """SELECT seller_id, total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue,
              avg_review_score IS NULL AS unrated
       FROM mart_olist_seller_performance""",
)
def proj_coalesce_defaults(given: Given) -> DataFrame:
    return given.mart("mart_olist_seller_performance").select(
        "seller_id",
        "total_orders",
        "total_revenue",
        F.col("avg_review_score").isNull().alias("unrated"),
    )


# joins


@check(
    "join_left_summary",
    """SELECT a.customer_id, CAST(b.total_orders AS DOUBLE) AS total_orders
       FROM stg_customers a LEFT JOIN order_figures b ON a.customer_id = b.customer_id""",
    gaps=("total_orders",),
)
def join_left_summary(given: Given) -> DataFrame:
    summary = marts.order_summary(given.staged("stg_orders"))
    return (
        given.staged("stg_customers")
        .join(summary, "customer_id", "left")
        .select("customer_id", "total_orders")
    )


@check(
    "join_left_payments",
    columns_sql(
        "priced_orders", "order_id customer_id order_status", "amount", "order_purchase_timestamp"
    ),
)
def join_left_payments(given: Given) -> DataFrame:
    return marts.orders_with_amount(
        given.staged("stg_olist_orders"), given.staged("stg_olist_order_payments")
    )


@check(
    "join_inner_customers",
    columns_sql(
        "known_orders",
        "customer_unique_id order_id order_status",
        "amount",
        "order_purchase_timestamp",
    ),
)
def join_inner_customers(given: Given) -> DataFrame:
    return marts.orders_of_customers(
        given.staged("stg_olist_orders"),
        given.staged("stg_olist_order_payments"),
        given.staged("stg_olist_customers"),
    )


@check(
    "join_left_fanout",
    columns_sql("reviewed_items", "seller_id order_id", "review_score price freight_value"),
    gaps=GAPS,
)
def join_left_fanout(given: Given) -> DataFrame:
    return marts.item_reviews(
        given.staged("stg_olist_order_items"), given.staged("stg_olist_order_reviews")
    )


@check(
    "join_left_sellers",
    """SELECT a.seller_id, a.seller_city, CAST(b.total_orders AS DOUBLE) AS total_orders
       FROM stg_olist_sellers a LEFT JOIN seller_figures b ON a.seller_id = b.seller_id""",
    gaps=("total_orders",),
)
def join_left_sellers(given: Given) -> DataFrame:
    figures = marts.seller_summary(
        given.staged("stg_olist_order_items"), given.staged("stg_olist_order_reviews")
    )
    return (
        given.staged("stg_olist_sellers")
        .join(figures, "seller_id", "left")
        .select("seller_id", "seller_city", "total_orders")
    )


# aggregates


@check(
    "agg_customer_summary",
    columns_sql(
        "order_figures",
        "customer_id total_orders avg_order_value completed_orders cancelled_orders",
        "lifetime_value",
        "first_order_date last_order_date",
    ),
)
def agg_customer_summary(given: Given) -> DataFrame:
    return marts.order_summary(given.staged("stg_orders"))


@check(
    "agg_count",
    """SELECT order_id, count(review_score) AS scores, count(*) AS reviews
       FROM stg_olist_order_reviews GROUP BY order_id""",
)
def agg_count(given: Given) -> DataFrame:
    reviews = given.staged("stg_olist_order_reviews")
    return reviews.groupBy("order_id").agg(
        F.count("review_score").alias("scores"), F.count(F.lit(1)).alias("reviews")
    )


@check("agg_sum", columns_sql("paid", "order_id", "amount"))
def agg_sum(given: Given) -> DataFrame:
    return marts.order_amounts(given.staged("stg_olist_order_payments"))


@check(
    "agg_avg",
    """SELECT seller_id, CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
       FROM stg_olist_order_items GROUP BY seller_id""",
)
def agg_avg(given: Given) -> DataFrame:
    items = given.staged("stg_olist_order_items")
    mean = mean_of(F.sum("price"), F.count("price"))
    return items.groupBy("seller_id").agg(mean.alias("avg_price"))


@check(
    "agg_min_max",
    """SELECT customer_id, CAST(min(order_date) AS VARCHAR) AS first_order_date,
              CAST(max(order_date) AS VARCHAR) AS last_order_date
       FROM stg_orders GROUP BY customer_id""",
)
def agg_min_max(given: Given) -> DataFrame:
    orders = given.staged("stg_orders")
    return orders.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )


COUNT_FILTER_SQL = """
    SELECT customer_id, count(order_id) FILTER (WHERE status = 'completed') AS completed_orders,
           count(order_id) FILTER (WHERE status = 'cancelled') AS cancelled_orders
    FROM stg_orders GROUP BY customer_id"""


@check("agg_count_filter", COUNT_FILTER_SQL)
def agg_count_filter(given: Given) -> DataFrame:
    status = F.col("status")
    return given.staged("stg_orders").groupBy("customer_id").agg(
        marts.count_where("order_id", status == "completed").alias("completed_orders"),
        marts.count_where("order_id", status == "cancelled").alias("cancelled_orders"),
    )


@check("filter_aggregate_only", COUNT_FILTER_SQL)
def filter_aggregate_only(given: Given) -> DataFrame:
    return given.staged("stg_orders").groupBy("customer_id").agg(
        F.expr("count(order_id) FILTER (WHERE status = 'completed')").alias("completed_orders"),
        F.expr("count(order_id) FILTER (WHERE status = 'cancelled')").alias("cancelled_orders"),
    )


@check(
    "agg_count_distinct",
    "SELECT seller_id, count(DISTINCT order_id) AS total_orders FROM reviewed_items GROUP BY seller_id",
)
def agg_count_distinct(given: Given) -> DataFrame:
    """Reviews repeat the orders of a seller but add none, so the items are enough."""
    items = given.staged("stg_olist_order_items")
    return items.groupBy("seller_id").agg(F.count_distinct("order_id").alias("total_orders"))


@check(
    "agg_mode",
    """SELECT s.o_custkey AS o_custkey, s.o_orderstatus AS status, p.o_orderpriority AS priority
       FROM (SELECT o_custkey, o_orderstatus, row_number() OVER
                    (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderstatus) AS place
             FROM orders GROUP BY o_custkey, o_orderstatus) s
       JOIN (SELECT o_custkey, o_orderpriority, row_number() OVER
                    (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS place
             FROM orders GROUP BY o_custkey, o_orderpriority) p
         ON s.o_custkey = p.o_custkey AND s.place = 1 AND p.place = 1""",
)
def agg_mode(given: Given) -> DataFrame:
    orders = given.table("orders").select(
        "o_custkey",
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )
    return modes_and_means(orders, "o_custkey", modes=("status", "priority"))


@check(
    "agg_seller_summary",
    columns_sql(
        "seller_figures",
        "seller_id total_orders avg_review_score reviewed_orders",
        "total_revenue total_freight",
    ),
)
def agg_seller_summary(given: Given) -> DataFrame:
    return marts.seller_summary(
        given.staged("stg_olist_order_items"), given.staged("stg_olist_order_reviews")
    )


@check("agg_customer_unique", MODEL_SQL["mart_olist_customer_orders"])
def agg_customer_unique(given: Given) -> DataFrame:
    return given.mart("mart_olist_customer_orders")


@check(
    "agg_having_dupes",
    """SELECT customer_unique_id, count(*) AS n_rows FROM stg_olist_customers
       WHERE customer_unique_id IS NOT NULL GROUP BY customer_unique_id HAVING count(*) > 1""",
)
def agg_having_dupes(given: Given) -> DataFrame:
    return repeated_values(given.staged("stg_olist_customers"), "customer_unique_id")


# windows, order, limits


@check(
    "window_latest_per_key",
    """SELECT id, source, model_name, column_name, description,
              CAST(updated_at AS VARCHAR) AS updated_at
       FROM (SELECT *, row_number() OVER (
                 PARTITION BY source, model_name, ifnull(column_name, '')
                 ORDER BY updated_at DESC NULLS FIRST, id DESC) AS place
             FROM event_rows) WHERE place = 1""",
)
def window_latest_per_key(given: Given) -> DataFrame:
    return latest_per_key(
        event_catalog(given.spark, given.sf_dir),
        ["source", "model_name", F.coalesce("column_name", F.lit(""))],
        [F.col("updated_at").desc_nulls_first(), F.col("id").desc()],
    )


@check("sort_simple", "SELECT source, description FROM event_rows ORDER BY source")
def sort_simple(given: Given) -> DataFrame:
    """By source. The id behind it lets a source with many rows be sorted by many tasks."""
    rows = event_catalog(given.spark, given.sf_dir)
    return rows.orderBy("source", "id").select("source", "description")


@check(
    "limit_one",
    """SELECT customer_zip_code_prefix FROM stg_olist_customers
       ORDER BY customer_id LIMIT 1""",
)
def limit_one(given: Given) -> DataFrame:
    rows = given.staged("stg_olist_customers").orderBy("customer_id")
    return rows.select("customer_zip_code_prefix").limit(1)
