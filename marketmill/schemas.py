"""Raw tables: file names, column order and types.

Raw columns are never inferred. Zip prefixes are text, so `01001` keeps its zero.
Whole-number keys are 64 bits wide, because 32 bits end long before the data does.
"""

from __future__ import annotations

# Landing file of each marketplace table.
MARKETPLACE_FILES = {
    "olist_customers_dataset.csv": "olist_customers",
    "olist_orders_dataset.csv": "olist_orders",
    "olist_order_items_dataset.csv": "olist_order_items",
    "olist_order_payments_dataset.csv": "olist_order_payments",
    "olist_order_reviews_dataset.csv": "olist_order_reviews",
    "olist_products_dataset.csv": "olist_products",
    "olist_sellers_dataset.csv": "olist_sellers",
    "olist_geolocation_dataset.csv": "olist_geolocation",
    "product_category_name_translation.csv": "olist_product_category_translation",
}

# Landing file of each seed table.
SEED_FILES = {
    "raw_customers.csv": "raw_customers",
    "raw_orders.csv": "raw_orders",
}

# Raw columns in file order, with their types.
RAW_COLUMNS = {
    "raw_customers": (
        ("customer_id", "bigint"),
        ("first_name", "string"),
        ("last_name", "string"),
        ("email", "string"),
        ("country", "string"),
        ("created_at", "date"),
    ),
    "raw_orders": (
        ("order_id", "bigint"),
        ("customer_id", "bigint"),
        ("order_date", "date"),
        ("status", "string"),
        ("amount", "decimal(10,2)"),
    ),
    "olist_customers": (
        ("customer_id", "string"),
        ("customer_unique_id", "string"),
        ("customer_zip_code_prefix", "string"),
        ("customer_city", "string"),
        ("customer_state", "string"),
    ),
    "olist_orders": (
        ("order_id", "string"),
        ("customer_id", "string"),
        ("order_status", "string"),
        ("order_purchase_timestamp", "timestamp_ntz"),
        ("order_approved_at", "timestamp_ntz"),
        ("order_delivered_carrier_date", "timestamp_ntz"),
        ("order_delivered_customer_date", "timestamp_ntz"),
        ("order_estimated_delivery_date", "timestamp_ntz"),
    ),
    "olist_order_items": (
        ("order_id", "string"),
        ("order_item_id", "int"),
        ("product_id", "string"),
        ("seller_id", "string"),
        ("shipping_limit_date", "timestamp_ntz"),
        ("price", "decimal(10,2)"),
        ("freight_value", "decimal(10,2)"),
    ),
    "olist_order_payments": (
        ("order_id", "string"),
        ("payment_sequential", "int"),
        ("payment_type", "string"),
        ("payment_installments", "int"),
        ("payment_value", "decimal(10,2)"),
    ),
    "olist_order_reviews": (
        ("review_id", "string"),
        ("order_id", "string"),
        ("review_score", "int"),
        ("review_comment_title", "string"),
        ("review_comment_message", "string"),
        ("review_creation_date", "timestamp_ntz"),
        ("review_answer_timestamp", "timestamp_ntz"),
    ),
    "olist_products": (
        ("product_id", "string"),
        ("product_category_name", "string"),
        ("product_name_lenght", "int"),
        ("product_description_lenght", "int"),
        ("product_photos_qty", "int"),
        ("product_weight_g", "decimal(18,4)"),
        ("product_length_cm", "decimal(18,4)"),
        ("product_height_cm", "decimal(18,4)"),
        ("product_width_cm", "decimal(18,4)"),
    ),
    "olist_sellers": (
        ("seller_id", "string"),
        ("seller_zip_code_prefix", "string"),
        ("seller_city", "string"),
        ("seller_state", "string"),
    ),
    "olist_geolocation": (
        ("geolocation_zip_code_prefix", "string"),
        ("geolocation_lat", "decimal(18,14)"),
        ("geolocation_lng", "decimal(18,14)"),
        ("geolocation_city", "string"),
        ("geolocation_state", "string"),
    ),
    "olist_product_category_translation": (
        ("product_category_name", "string"),
        ("product_category_name_english", "string"),
    ),
}

# Only free text holds line breaks. To split such a file between tasks, the quotes before
# each split must be known; the other tables are read line by line.
MULTI_LINE_TABLES = frozenset({"olist_order_reviews"})

# Nested catalog document: node id -> what is documented about it.
MANIFEST_SCHEMA = """
    nodes map<string, struct<
        resource_type: string,
        name: string,
        description: string,
        columns: map<string, struct<description: string>>
    >>
"""

CATALOG_COLUMNS = ("source", "model_name", "column_name", "description")
