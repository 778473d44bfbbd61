"""The 73 data tests of the warehouse."""

from __future__ import annotations

from marketmill.operators.quality import (
    AcceptedValues,
    ExpressionIsTrue,
    NotNull,
    Relationship,
    Singular,
    Test,
    Unique,
)

# Columns that are never NULL.
NOT_NULL = {
    "stg_customers": ("customer_id", "email", "first_name", "country_code", "created_at"),
    "stg_orders": ("order_id", "customer_id", "order_date", "status", "amount"),
    "mart_customer_orders": (
        "customer_id",
        "email",
        "lifetime_value",
        "total_orders",
        "completed_orders",
        "cancelled_orders",
    ),
    "mart_customer_orders_masked": ("customer_id",),
    "stg_olist_customers": ("customer_id", "customer_unique_id"),
    "stg_olist_orders": ("order_id", "customer_id", "order_status"),
    "stg_olist_order_items": ("order_id", "seller_id", "price"),
    "stg_olist_order_payments": ("order_id", "payment_type", "payment_value"),
    "stg_olist_order_reviews": ("review_id", "order_id", "review_score"),
    "stg_olist_products": ("product_id",),
    "stg_olist_sellers": ("seller_id",),
    "stg_olist_geolocation": ("geolocation_zip_code_prefix",),
    "stg_olist_product_category_translation": ("product_category_name",),
    "mart_olist_customer_orders": ("customer_unique_id", "lifetime_value", "total_orders"),
    "mart_olist_seller_performance": ("seller_id", "total_revenue"),
}

# Columns that hold each value once.
UNIQUE = {
    "stg_customers": ("customer_id", "email"),
    "stg_orders": ("order_id",),
    "mart_customer_orders": ("customer_id", "email"),
    "mart_customer_orders_masked": ("customer_id",),
    "stg_olist_customers": ("customer_id",),
    "stg_olist_orders": ("order_id",),
    "stg_olist_products": ("product_id",),
    "stg_olist_sellers": ("seller_id",),
    "stg_olist_geolocation": ("geolocation_zip_code_prefix",),
    "stg_olist_product_category_translation": ("product_category_name",),
    "mart_olist_customer_orders": ("customer_unique_id",),
    "mart_olist_seller_performance": ("seller_id",),
}

# Model, column, allowed values.
ACCEPTED_VALUES = (
    ("stg_orders", "status", ("completed", "shipped", "pending", "cancelled")),
    (
        "stg_olist_orders",
        "order_status",
        (
            "created",
            "invoiced",
            "processing",
            "unavailable",
            "shipped",
            "delivered",
            "canceled",
            "approved",
        ),
    ),
    (
        "stg_olist_order_payments",
        "payment_type",
        ("credit_card", "boleto", "voucher", "debit_card", "not_defined"),
    ),
    ("stg_olist_order_reviews", "review_score", (1, 2, 3, 4, 5)),
)

# Child, its key, parent, the parent's key.
RELATIONSHIPS = (
    ("stg_orders", "customer_id", "stg_customers", "customer_id"),
    ("stg_olist_orders", "customer_id", "stg_olist_customers", "customer_id"),
    ("stg_olist_order_items", "order_id", "stg_olist_orders", "order_id"),
    ("stg_olist_order_items", "seller_id", "stg_olist_sellers", "seller_id"),
    ("stg_olist_order_payments", "order_id", "stg_olist_orders", "order_id"),
    ("stg_olist_order_reviews", "order_id", "stg_olist_orders", "order_id"),
)

# Model, column, what must hold for it.
EXPRESSIONS = (
    ("stg_customers", "email", "like '%@%'"),
    ("stg_orders", "amount", "> 0"),
    ("mart_customer_orders", "lifetime_value", ">= 0"),
    ("stg_olist_order_items", "price", ">= 0"),
    ("stg_olist_order_payments", "payment_value", ">= 0"),
    ("mart_olist_customer_orders", "lifetime_value", ">= 0"),
    ("mart_olist_seller_performance", "total_revenue", ">= 0"),
)

# Model, column reported, forbidden condition, columns shown.
SINGULAR = (
    (
        "mart_customer_orders",
        "customer_id",
        "completed_orders + cancelled_orders > total_orders",
        ("customer_id", "total_orders", "completed_orders", "cancelled_orders"),
    ),
    (
        "mart_olist_customer_orders",
        "customer_unique_id",
        "delivered_orders + cancelled_orders > total_orders",
        ("customer_unique_id", "total_orders", "delivered_orders", "cancelled_orders"),
    ),
)


def suite() -> list[Test]:
    return [
        *(NotNull(model, column) for model, names in NOT_NULL.items() for column in names),
        *(Unique(model, column) for model, names in UNIQUE.items() for column in names),
        *(AcceptedValues(*rule) for rule in ACCEPTED_VALUES),
        *(Relationship(*rule) for rule in RELATIONSHIPS),
        *(ExpressionIsTrue(*rule) for rule in EXPRESSIONS),
        *(Singular(*rule) for rule in SINGULAR),
    ]


def tests_of(*models: str) -> list[Test]:
    return [test for test in suite() if test.model in models]
