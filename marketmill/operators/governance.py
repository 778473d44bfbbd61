"""Grants and row rules of the roles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Roles, layers and granted tables.
ENGINEER = "engineer"
ANALYST = "analyst"
LAYERS = ("raw", "staging", "marts", "olist_staging", "olist_marts")
ANALYST_TABLES = {
    ("marts", "mart_customer_orders_masked"),
    ("olist_marts", "mart_olist_customer_orders"),
    ("olist_marts", "mart_olist_seller_performance"),
}

# Rows a role may see of tables with row rules. A role without a rule
# on such a table sees none of its rows.
ROW_POLICIES = {
    "mart_customer_orders": {ENGINEER: "true", ANALYST: "completed_orders > 0"},
    "mart_olist_customer_orders": {ENGINEER: "true", ANALYST: "delivered_orders > 0"},
}


@dataclass(frozen=True)
class Access:
    role: str
    layer: str
    table: str

    @property
    def granted(self) -> bool:
        if self.role == ENGINEER:
            return self.layer in LAYERS
        return self.role == ANALYST and (self.layer, self.table) in ANALYST_TABLES


def with_row_policy(df: DataFrame, role: str, table: str) -> DataFrame:
    """`df` limited to the rows the role's rule on `table` lets through."""
    rules = ROW_POLICIES.get(table)
    if rules is None:
        return df
    return df.where(F.expr(rules.get(role, "false")))
