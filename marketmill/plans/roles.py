"""What each role may read of a warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marketmill.operators.governance import Access, with_row_policy
from marketmill.plans.build import MART_NAMESPACES
from marketmill.plans.marts import customer_orders_masked
from marketmill.plans.staging import MARKETPLACE_MODELS, TOY_MODELS, raw_table_of, staging
from marketmill.schemas import RAW_COLUMNS
from marketmill.sources.tables import Warehouse

MASKED = ("marts", "mart_customer_orders_masked")
STAGING_LAYERS = {"staging": TOY_MODELS, "olist_staging": MARKETPLACE_MODELS}


def all_tables() -> list[tuple[str, str]]:
    """(layer, table) of everything a role could ask for."""
    raw = [("raw", table) for table in RAW_COLUMNS]
    staged = [(layer, model) for layer, models in STAGING_LAYERS.items() for model in models]
    marts = [(layer, mart) for mart, layer in MART_NAMESPACES.items()]
    return [*raw, *staged, *marts, MASKED]


def table_of(warehouse: Warehouse, layer: str, table: str) -> DataFrame:
    """A table as its layer defines it, from what the warehouse has stored."""
    if (layer, table) == MASKED:
        return customer_orders_masked(warehouse.read("marts", "mart_customer_orders"))
    if layer in STAGING_LAYERS:
        return staging(table, warehouse.read("raw", raw_table_of(table)))
    return warehouse.read(layer, table)


def role_view(warehouse: Warehouse, role: str, layer: str, table: str) -> DataFrame:
    """`table` as `role` sees it; PermissionError where nothing was granted.

    The table is looked up and masked here, so no caller can hand in other rows under a
    granted name. The masked view carries no row rule: it shows every customer, but no
    full address.
    """
    if not Access(role, layer, table).granted:
        raise PermissionError(f"{role} may not read {layer}.{table}")
    return with_row_policy(table_of(warehouse, layer, table), role, table)


def register_role_views(warehouse: Warehouse, role: str) -> list[str]:
    """Session views `<role>_<layer>_<table>` of all that `role` may read; their names."""
    made = []
    for layer, table in all_tables():
        if Access(role, layer, table).granted:
            name = f"{warehouse.prefix}{role}_{layer}_{table}"
            role_view(warehouse, role, layer, table).createOrReplaceTempView(name)
            made.append(name)
    return made
