"""Staging tables: raw columns cleaned, renamed and typed.

A staging table is a tuple of column rules. Applied to a raw table it is a lazy
projection that melts into whatever reads it, so filters and column choices of a
mart reach the raw scan. Locations are the one table that is aggregated here.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame

from marketmill.functions.numbers import money, rounded_int
from marketmill.functions.text import as_column, lower_trimmed, trimmed, upper_trimmed
from marketmill.operators.modes import modes_and_means

Rule = Callable[[str], Column]


def cast_to(kind: str) -> Rule:
    return lambda name: as_column(name).cast(kind)


text = cast_to("string")
day = cast_to("date")
moment = cast_to("timestamp_ntz")
measure = cast_to("decimal(18,4)")
degree = cast_to("decimal(18,14)")
whole = rounded_int

# raw column, rule, and the staging name where it differs
RULES: dict[str, tuple[tuple, ...]] = {
    "stg_customers": (
        ("customer_id", cast_to("bigint")),
        ("first_name", trimmed),
        ("last_name", trimmed),
        ("email", lower_trimmed),
        ("country", upper_trimmed, "country_code"),
        ("created_at", day),
    ),
    "stg_orders": (
        ("order_id", cast_to("bigint")),
        ("customer_id", cast_to("bigint")),
        ("order_date", day),
        ("status", lower_trimmed),
        ("amount", money),
    ),
    "stg_olist_customers": (
        ("customer_id", text),
        ("customer_unique_id", text),
        ("customer_zip_code_prefix", text),
        ("customer_city", lower_trimmed),
        ("customer_state", upper_trimmed),
    ),
    "stg_olist_orders": (
        ("order_id", text),
        ("customer_id", text),
        ("order_status", lower_trimmed),
        ("order_purchase_timestamp", moment),
        ("order_approved_at", moment),
        ("order_delivered_carrier_date", moment),
        ("order_delivered_customer_date", moment),
        ("order_estimated_delivery_date", moment),
    ),
    "stg_olist_order_items": (
        ("order_id", text),
        ("order_item_id", whole),
        ("product_id", text),
        ("seller_id", text),
        ("shipping_limit_date", moment),
        ("price", money),
        ("freight_value", money),
    ),
    "stg_olist_order_payments": (
        ("order_id", text),
        ("payment_sequential", whole),
        ("payment_type", lower_trimmed),
        ("payment_installments", whole),
        ("payment_value", money),
    ),
    "stg_olist_order_reviews": (
        ("review_id", text),
        ("order_id", text),
        ("review_score", whole),
        ("review_comment_title", trimmed),
        ("review_comment_message", trimmed),
        ("review_creation_date", moment),
        ("review_answer_timestamp", moment),
    ),
    "stg_olist_products": (
        ("product_id", text),
        ("product_category_name", trimmed),
        ("product_name_lenght", whole, "product_name_length"),
        ("product_description_lenght", whole, "product_description_length"),
        ("product_photos_qty", whole),
        ("product_weight_g", measure),
        ("product_length_cm", measure),
        ("product_height_cm", measure),
        ("product_width_cm", measure),
    ),
    "stg_olist_sellers": (
        ("seller_id", text),
        ("seller_zip_code_prefix", text),
        ("seller_city", lower_trimmed),
        ("seller_state", upper_trimmed),
    ),
    "stg_olist_geolocation": (
        ("geolocation_zip_code_prefix", text),
        ("geolocation_lat", degree),
        ("geolocation_lng", degree),
        ("geolocation_city", lower_trimmed),
        ("geolocation_state", upper_trimmed),
    ),
    "stg_olist_product_category_translation": (
        ("product_category_name", trimmed),
        ("product_category_name_english", trimmed),
    ),
}

TOY_MODELS = ("stg_customers", "stg_orders")
MARKETPLACE_MODELS = tuple(model for model in RULES if model not in TOY_MODELS)


def raw_table_of(model: str) -> str:
    """`stg_orders` reads `raw_orders`, `stg_olist_orders` reads `olist_orders`."""
    name = model.removeprefix("stg_")
    return f"raw_{name}" if model in TOY_MODELS else name


def cleaned(model: str, raw: DataFrame) -> DataFrame:
    """The column rules of `model`, row by row.

    Whole numbers are rounded only where the raw column is not one already, so that
    filters on those that are can be pushed to the scan.
    """
    kinds = dict(raw.dtypes)
    columns = []
    for name, rule, *renamed in RULES[model]:
        is_whole = rule is whole and kinds[name] == "int"
        value = as_column(name) if is_whole else rule(name)
        columns.append(value.alias(*(renamed or [name])))
    return raw.select(*columns)


def one_per_prefix(places: DataFrame) -> DataFrame:
    """Locations at the grain they can be joined at: one row per zip prefix."""
    return modes_and_means(
        places,
        "geolocation_zip_code_prefix",
        modes=("geolocation_city", "geolocation_state"),
        means=("geolocation_lat", "geolocation_lng"),
    )


def staging(model: str, raw: DataFrame) -> DataFrame:
    rows = cleaned(model, raw)
    return one_per_prefix(rows) if model == "stg_olist_geolocation" else rows


def all_staging(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Every staging table whose raw table is there."""
    return {
        model: staging(model, raw[raw_table_of(model)])
        for model in RULES
        if raw_table_of(model) in raw
    }
