"""Marts: one row per customer, per marketplace customer and per seller.

Facts are always reduced to one row per join key before they are joined. The joins
then see unique keys on one side at least, and the rows of a key that fills a third
of a table have been merged before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketmill.functions.numbers import mean_of, of_units, or_zero, smallest_units
from marketmill.functions.text import masked_email

TOTAL = "decimal(20,2)"
HOT_SHARE = 0.001  # of the items, above which an order is spread
SPREAD = 64
MONEY_DIGITS = 10  # a whole number holds 900 million of the largest such values


def count_where(column: str, condition: Column) -> Column:
    return F.count(F.when(condition, F.col(column)))


def order_summary(orders: DataFrame) -> DataFrame:
    """Order figures per customer."""
    status = F.col("status")
    return orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("amount").alias("lifetime_value"),
        mean_of(F.sum("amount"), F.count("amount")).alias("avg_order_value"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        count_where("order_id", status == "completed").alias("completed_orders"),
        count_where("order_id", status == "cancelled").alias("cancelled_orders"),
    )


def customer_orders(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Every customer with the figures of their orders, zeros where there are none."""
    figures = customers.join(order_summary(orders), "customer_id", "left")
    return figures.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "country_code",
        F.col("created_at").alias("customer_since"),
        or_zero("total_orders", "bigint").alias("total_orders"),
        or_zero("lifetime_value", TOTAL).alias("lifetime_value"),
        or_zero("avg_order_value", "double").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        or_zero("completed_orders", "bigint").alias("completed_orders"),
        or_zero("cancelled_orders", "bigint").alias("cancelled_orders"),
    )


def customer_orders_masked(mart: DataFrame, strict: bool = False) -> DataFrame:
    """What analysts get of the customer mart: no names, no full address."""
    return mart.select(
        "customer_id",
        masked_email("email", strict).alias("email"),
        "lifetime_value",
        "total_orders",
        "completed_orders",
        "cancelled_orders",
    )


def cents_scale(df: DataFrame, column: str) -> int | None:
    """Digits after the point of a money column whose sums are moved as whole numbers."""
    kind = df.schema[column].dataType
    narrow = isinstance(kind, T.DecimalType) and kind.precision <= MONEY_DIGITS
    return kind.scale if narrow else None


def money_sum(df: DataFrame, column: str) -> Column:
    """The sum of a money column, in whole cents where `cents_scale` allows: half the bytes."""
    scale = cents_scale(df, column)
    return F.sum(column if scale is None else smallest_units(column, scale))


def in_money(total: Column, scale: int | None) -> Column:
    return total if scale is None else of_units(total, scale).cast(TOTAL)


def order_amounts(payments: DataFrame) -> DataFrame:
    scale = cents_scale(payments, "payment_value")
    paid = payments.groupBy("order_id").agg(money_sum(payments, "payment_value").alias("amount"))
    return paid.withColumn("amount", in_money(F.col("amount"), scale))


def orders_with_amount(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Every order with what was paid for it; 0.00 where nothing was."""
    return orders.join(order_amounts(payments), "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        or_zero("amount", TOTAL).alias("amount"),
    )


def orders_of_customers(
    orders: DataFrame, payments: DataFrame, customers: DataFrame
) -> DataFrame:
    """Orders under the customer they belong to; orders without one are dropped."""
    known = customers.select("customer_id", "customer_unique_id")
    return (
        orders_with_amount(orders, payments)
        .join(known, "customer_id")
        .select(
            "customer_unique_id",
            "order_id",
            "order_status",
            "order_purchase_timestamp",
            "amount",
        )
    )


def marketplace_customer_orders(
    orders: DataFrame, payments: DataFrame, customers: DataFrame
) -> DataFrame:
    """Order figures per returning customer, who has a new `customer_id` per order.

    The figures are taken per `customer_id` first. That is the shuffle the join needs
    anyway, it keeps the join free of hot keys, and counts, sums and extremes can be
    merged again per `customer_unique_id` without changing the result. An order
    without payment counts as 0.00 in the average.
    """
    status = F.col("order_status")
    bought = F.col("order_purchase_timestamp")
    per_id = (
        orders_with_amount(orders, payments)
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("orders"),
            F.count(F.lit(1)).alias("amounts"),
            F.sum("amount").alias("amount"),
            F.min(bought).alias("first"),
            F.max(bought).alias("last"),
            count_where("order_id", status == "delivered").alias("delivered"),
            count_where("order_id", status == "canceled").alias("cancelled"),
        )
    )
    known = customers.select("customer_id", "customer_unique_id")
    return (
        per_id.join(known, "customer_id")
        .groupBy("customer_unique_id")
        .agg(
            F.sum("orders").alias("total_orders"),
            F.sum("amount").cast(TOTAL).alias("lifetime_value"),
            mean_of(F.sum("amount"), F.sum("amounts")).alias("avg_order_value"),
            F.min("first").alias("first_order_date"),
            F.max("last").alias("last_order_date"),
            F.sum("delivered").alias("delivered_orders"),
            F.sum("cancelled").alias("cancelled_orders"),
        )
    )


def item_reviews(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Items with the reviews of their order, one row for each pair.

    An item of an order with two reviews is there twice, and so are its price and
    freight in every sum over these rows. The seller mart gets the same sums without
    these rows (`seller_summary`); this is for looking at the rows themselves.
    """
    scores = reviews.select("order_id", "review_score")
    return items.select("seller_id", "order_id", "price", "freight_value").join(
        scores, "order_id", "left"
    )


def hot_orders(items: DataFrame) -> DataFrame:
    """(order_id, hot): every order with more than HOT_SHARE of the items, from one pass;
    some others may be among them, at most 1 / HOT_SHARE in all."""
    found = items.stat.freqItems(["order_id"], HOT_SHARE)
    each = found.select(F.explode("order_id_freqItems").alias("order_id"))
    return each.where(F.col("order_id").isNotNull()).withColumn("hot", F.lit(True))


def per_review(column: str, scale: int | None) -> Column:
    """Sum of an order's money, times its reviews where there are more than one.

    Only such orders are multiplied, as decimals: their product may pass 64 bits.
    """
    if scale is None:
        times = F.coalesce("reviews", F.lit(1)).cast("decimal(18,0)")
        return F.sum(F.col(column) * times).cast(TOTAL)
    more = of_units(column, scale) * (F.col("reviews") - 1).cast("decimal(18,0)")
    repeated = F.sum(F.when(F.col("reviews") > 1, more))
    once = of_units(F.sum(column), scale)
    return (once + F.coalesce(repeated, F.lit(0))).cast(TOTAL)


def seller_summary(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Figures per seller over `item_reviews`, without building those rows.

    Items are reduced to one row per seller and order, reviews to one row per order.
    With n items and m reviews in such a pair, the pairwise rows would hold every
    price max(m, 1) times and every score n times, so the sums are multiplied by
    that. One row per seller and order is left, which makes the distinct count of
    orders a plain count.

    Items are moved once, to the reviews of their order. Orders that hold a large share
    of them, and items without order, are spread over SPREAD parts; reviews of such an
    order go to each of these, and it is counted as one by its id.
    """
    hot = hot_orders(items)
    dealt = items.join(F.broadcast(hot), "order_id", "left").withColumn(
        "spread", F.coalesce("hot", F.col("order_id").isNull())
    )
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SPREAD)).cast("int")
    per_order = (
        dealt.withColumn("part", F.when(F.col("spread"), part).otherwise(0))
        .select("order_id", "part", "spread", "seller_id", "price", "freight_value")
        .repartition("order_id", "part")
        .groupBy("order_id", "part", "spread", "seller_id")
        .agg(
            F.count(F.lit(1)).alias("items"),
            money_sum(items, "price").alias("price"),
            money_sum(items, "freight_value").alias("freight"),
        )
    )
    parts = F.sequence(F.lit(0), F.when(F.col("hot"), SPREAD - 1).otherwise(0))
    of_order = (
        reviews.groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("reviews"),
            F.count("review_score").alias("scores"),
            F.sum("review_score").alias("score"),
        )
        .join(F.broadcast(hot), "order_id", "left")
        .withColumn("part", F.explode(parts))
        .drop("hot")
    )
    score = F.sum(F.col("score") * F.col("items"))
    scores = F.sum(F.col("scores") * F.col("items"))
    spread_order = F.when(F.col("spread"), F.col("order_id"))
    return (
        per_order.join(of_order, ["order_id", "part"], "left")
        .groupBy("seller_id")
        .agg(
            (F.count_if(~F.col("spread")) + F.count_distinct(spread_order)).alias("total_orders"),
            per_review("price", cents_scale(items, "price")).alias("total_revenue"),
            per_review("freight", cents_scale(items, "freight_value")).alias("total_freight"),
            mean_of(score, scores).alias("avg_review_score"),
            F.coalesce(scores, F.lit(0)).alias("reviewed_orders"),
        )
    )


def seller_performance(sellers: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Every seller with the figures of their items, zeros where there are none."""
    figures = sellers.join(seller_summary(items, reviews), "seller_id", "left")
    return figures.select(
        "seller_id",
        "seller_city",
        "seller_state",
        or_zero("total_orders", "bigint").alias("total_orders"),
        or_zero("total_revenue", TOTAL).alias("total_revenue"),
        or_zero("total_freight", TOTAL).alias("total_freight"),
        "avg_review_score",
        or_zero("reviewed_orders", "bigint").alias("reviewed_orders"),
    )


# The marts that are stored as tables, and the staging tables they read.
MARTS = {
    "mart_customer_orders": (customer_orders, ("stg_customers", "stg_orders")),
    "mart_olist_customer_orders": (
        marketplace_customer_orders,
        ("stg_olist_orders", "stg_olist_order_payments", "stg_olist_customers"),
    ),
    "mart_olist_seller_performance": (
        seller_performance,
        ("stg_olist_sellers", "stg_olist_order_items", "stg_olist_order_reviews"),
    ),
}


def mart(name: str, staged: Callable[[str], DataFrame]) -> DataFrame:
    """One of the marts, over whatever `staged` gives for the staging names."""
    build, inputs = MARTS[name]
    return build(*map(staged, inputs))


def all_marts(staged: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: mart(name, staged.__getitem__) for name in MARTS}
