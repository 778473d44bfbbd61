"""Filters, scalar functions, data tests and role views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.checks.damage import PREFIX, damaged
from marketmill.checks.inputs import Given, event_catalog, manifests
from marketmill.checks.models import MODEL_SQL
from marketmill.checks.registry import check
from marketmill.functions import text
from marketmill.functions.numbers import money, rounded_int
from marketmill.functions.vectors import (
    checked_vector,
    cosine_distance,
    parse_vector,
    vector_text,
)
from marketmill.operators import quality
from marketmill.operators.descriptions import exploded_columns, exploded_nodes, models_only
from marketmill.operators.governance import ANALYST, ENGINEER, with_row_policy
from marketmill.operators.latest import latest_per_key
from marketmill.operators.upsert import without
from marketmill.plans.build import MART_NAMESPACES
from marketmill.plans.marts import customer_orders_masked
from marketmill.plans.quality_suite import NOT_NULL, suite, tests_of
from marketmill.plans.roles import all_tables, role_view
from marketmill.sources.tables import Warehouse, in_parallel

# filters


@check(
    "filter_cross_column",
    """SELECT customer_id, CAST(total_orders AS DOUBLE) AS total_orders,
              CAST(completed_orders AS DOUBLE) AS completed_orders,
              CAST(cancelled_orders AS DOUBLE) AS cancelled_orders
       FROM damaged_mart_customer_orders
       WHERE NOT (completed_orders + cancelled_orders > total_orders)""",
    gaps=("total_orders", "completed_orders", "cancelled_orders"),
)
def filter_cross_column(given: Given) -> DataFrame:
    """Drops the rows that were made to count more orders than there are."""
    return Models(given).damaged("mart_customer_orders").where(
        ~(F.col("completed_orders") + F.col("cancelled_orders") > F.col("total_orders"))
    ).select("customer_id", "total_orders", "completed_orders", "cancelled_orders")


POLICY_SQL = MODEL_SQL["mart_customer_orders"] + " WHERE completed_orders > 0"
POLICY_MARKET_SQL = MODEL_SQL["mart_olist_customer_orders"] + " WHERE delivered_orders > 0"


@check("filter_row_policy", POLICY_SQL)
def filter_row_policy(given: Given) -> DataFrame:
    mart = given.mart("mart_customer_orders")
    return with_row_policy(mart, ANALYST, "mart_customer_orders")


@check(
    "filter_rank",
    """SELECT model_name, description FROM (
           SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY id DESC) AS place
           FROM event_rows) WHERE place = 1""",
)
def filter_rank(given: Given) -> DataFrame:
    rows = event_catalog(given.spark, given.sf_dir)
    return latest_per_key(rows, ["model_name"], [F.col("id").desc()]).select(
        "model_name", "description"
    )


@check(
    "filter_like",
    """SELECT CAST(customer_id AS DOUBLE) AS customer_id, email FROM damaged_stg_customers
       WHERE email LIKE '%@%'""",
    gaps=("customer_id",),
)
def filter_like(given: Given) -> DataFrame:
    """Drops the rows without an address or with one that is none."""
    rows = Models(given).damaged("stg_customers").where(F.col("email").like("%@%"))
    return rows.select("customer_id", "email")


@check(
    "filter_range_sign",
    """SELECT order_id, order_item_id, CAST(freight_value AS DOUBLE) AS freight_value
       FROM stg_olist_order_items WHERE price >= 0 AND freight_value > 0""",
)
def filter_range_sign(given: Given) -> DataFrame:
    items = given.staged("stg_olist_order_items")
    return items.where((F.col("price") >= 0) & (F.col("freight_value") > 0)).select(
        "order_id", "order_item_id", "freight_value"
    )


@check(
    "filter_in_set",
    """SELECT review_id, review_score FROM stg_olist_order_reviews
       WHERE review_score IN (1, 2, 3, 4, 5)""",
)
def filter_in_set(given: Given) -> DataFrame:
    reviews = given.staged("stg_olist_order_reviews")
    return reviews.where(F.col("review_score").isin(1, 2, 3, 4, 5)).select(
        "review_id", "review_score"
    )


@check(
    "filter_resource_type",
    "SELECT node_id, name, description FROM nodes WHERE resource_type = 'model'",
)
def filter_resource_type(given: Given) -> DataFrame:
    nodes = exploded_nodes(manifests(given.spark, given.sf_dir))
    return models_only(nodes).select("node_id", "name", "description")


@check(
    "filter_point_delete",
    """SELECT id, model_name, column_name FROM event_rows
       WHERE column_name IS DISTINCT FROM 'click'""",
)
def filter_point_delete(given: Given) -> DataFrame:
    rows = event_catalog(given.spark, given.sf_dir)
    return without(rows, F.col("column_name") == "click").select(
        "id", "model_name", "column_name"
    )


# scalar functions


@check("fn_trim", "SELECT customer_id, trim(first_name) AS first_name FROM raw_customers")
def fn_trim(given: Given) -> DataFrame:
    return given.raw("raw_customers").select(
        "customer_id", text.trimmed("first_name").alias("first_name")
    )


@check(
    "fn_strip_whitespace",
    """SELECT page_id, trim(html, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
              AS html,
              trim(chr(9) || ' ' || chr(13) || html || chr(12) || chr(10) || ' ',
                   ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS wrapped
       FROM pages""",
)
def fn_strip_whitespace(given: Given) -> DataFrame:
    wrapped = F.concat(F.lit("\t \r"), "html", F.lit("\x0c\n "))
    return given.table("pages").select(
        "page_id", text.stripped("html").alias("html"), text.stripped(wrapped).alias("wrapped")
    )


@check("fn_lower", "SELECT customer_id, lower(trim(email)) AS email FROM raw_customers")
def fn_lower(given: Given) -> DataFrame:
    return given.raw("raw_customers").select(
        "customer_id", text.lower_trimmed("email").alias("email")
    )


@check("fn_upper", "SELECT customer_id, upper(trim(country)) AS country FROM raw_customers")
def fn_upper(given: Given) -> DataFrame:
    return given.raw("raw_customers").select(
        "customer_id", text.upper_trimmed("country").alias("country")
    )


@check(
    "fn_cast",
    """SELECT l_orderkey, l_linenumber,
              CAST(round_even(l_quantity * 0.5, 0) AS INTEGER) AS halves,
              CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS DOUBLE) AS price,
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped
       FROM lineitem""",
)
def fn_cast(given: Given) -> DataFrame:
    return given.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        rounded_int(F.col("l_quantity") * 0.5).alias("halves"),
        money("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("date").alias("shipped"),
    )


@check(
    "fn_coalesce",
    """SELECT a.customer_id, coalesce(b.total_orders, 0) AS total_orders
       FROM stg_customers a LEFT JOIN order_figures b ON a.customer_id = b.customer_id""",
)
def fn_coalesce(given: Given) -> DataFrame:
    return given.mart("mart_customer_orders").select("customer_id", "total_orders")


@check(
    "fn_mask_email",
    r"""SELECT customer_id,
               regexp_replace(email, '(^.{1})[^@]+(@.+$)', '\1****\2') AS email,
               regexp_replace(local, '(^.{1})[^@]+(@.+$)', '\1****\2') AS short_email
        FROM (SELECT customer_id, email, left(email, 1) || '@example.com' AS local
              FROM stg_customers)""",
)
def fn_mask_email(given: Given) -> DataFrame:
    short = F.concat(F.substring("email", 1, 1), F.lit("@example.com"))
    return given.staged("stg_customers").select(
        "customer_id",
        text.masked_email("email").alias("email"),
        text.masked_email(short).alias("short_email"),
    )


@check(
    "fn_arith_compare",
    """SELECT customer_id, CAST(completed_orders + cancelled_orders AS DOUBLE) AS ended,
              ifnull(completed_orders + cancelled_orders > total_orders, false) AS too_many,
              CAST(1 - total_orders AS DOUBLE) AS rest
       FROM damaged_mart_customer_orders WHERE customer_id IS NOT NULL""",
    gaps=("ended", "rest"),
)
def fn_arith_compare(given: Given) -> DataFrame:
    ended = F.col("completed_orders") + F.col("cancelled_orders")
    rows = Models(given).damaged("mart_customer_orders").where("customer_id IS NOT NULL")
    return rows.select(
        "customer_id",
        ended.alias("ended"),
        F.coalesce(ended > F.col("total_orders"), F.lit(False)).alias("too_many"),
        (1 - F.col("total_orders")).alias("rest"),
    )


@check(
    "fn_concat_label",
    """SELECT id, model_name || '.' || column_name || ': ' || description AS label
       FROM event_rows""",
)
def fn_concat_label(given: Given) -> DataFrame:
    label = F.concat("model_name", F.lit("."), "column_name", F.lit(": "), "description")
    return event_catalog(given.spark, given.sf_dir).select("id", label.alias("label"))


@check(
    "fn_cosine_distance",
    """SELECT a.id, round(1 - list_dot_product(a.v, b.v) / (a.len * b.len), 6) + 0.0 AS distance
       FROM lengths a JOIN lengths b ON b.id = a.label""",
)
def fn_cosine_distance(given: Given) -> DataFrame:
    """Distance of every vector to the one whose id is its label."""
    vectors = given.table("embeddings")
    other = vectors.select(F.col("vec_id").alias("label"), F.col("embedding").alias("other"))
    distance = F.round(cosine_distance("embedding", "other"), 6) + 0.0  # no minus zero
    return vectors.join(other.withColumn("label", F.col("label").cast("int")), "label").select(
        F.col("vec_id").alias("id"), distance.alias("distance")
    )


@check(
    "fn_vector_parse",
    """SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dimensions,
              unnest(CAST(embedding AS DOUBLE[])) AS value,
              generate_subscripts(embedding, 1) AS place
       FROM embeddings""",
)
def fn_vector_parse(given: Given) -> DataFrame:
    parsed = parse_vector(vector_text("embedding"))
    rows = given.table("embeddings").select("vec_id", parsed.alias("v"))
    dimensions = F.size(checked_vector("v", 64))
    return rows.select(
        "vec_id", dimensions.alias("dimensions"), F.posexplode("v").alias("at", "value")
    ).select(
        "vec_id",
        "dimensions",
        F.col("value").cast("double").alias("value"),
        (F.col("at") + 1).cast("bigint").alias("place"),
    )


@check(
    "fn_now",
    """SELECT id, '2024-06-01 12:00:00' AS updated_at, description FROM event_rows""",
)
def fn_now(given: Given) -> DataFrame:
    """The run's time is given to it, so a rerun writes the same rows."""
    now = F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")
    rows = event_catalog(given.spark, given.sf_dir)
    return rows.select("id", now.alias("updated_at"), "description")


@check(
    "map_explode_nodes",
    "SELECT node_id, resource_type, name, length(description) AS n FROM nodes",
)
def map_explode_nodes(given: Given) -> DataFrame:
    nodes = exploded_nodes(manifests(given.spark, given.sf_dir))
    return nodes.select(
        "node_id", "resource_type", "name", F.length("description").cast("bigint").alias("n")
    )


@check(
    "map_explode_columns",
    "SELECT name, column_name, column_description FROM node_columns",
)
def map_explode_columns(given: Given) -> DataFrame:
    nodes = exploded_nodes(manifests(given.spark, given.sf_dir))
    return exploded_columns(nodes).select("name", "column_name", "column_description")


@check(
    "json_get_default",
    """SELECT name, column_name, ifnull(column_description, '') AS text
       FROM node_columns""",
)
def json_get_default(given: Given) -> DataFrame:
    nodes = exploded_nodes(manifests(given.spark, given.sf_dir))
    return exploded_columns(nodes).select(
        "name", "column_name", F.coalesce("column_description", F.lit("")).alias("text")
    )


# data tests


def one(model: str, column: str, name: str):
    found = [t for t in tests_of(model) if t.column == column and t.name == name]
    return found[0]


@check(
    "dq_not_null", "SELECT review_id FROM stg_olist_order_reviews WHERE review_score IS NULL"
)
def dq_not_null(given: Given) -> DataFrame:
    test = one("stg_olist_order_reviews", "review_score", "not_null")
    return quality.failing_rows(test, given.model(test.model)).select("review_id")


@check(
    "dq_unique",
    """SELECT seller_state, count(*) AS n_rows FROM stg_olist_sellers
       WHERE seller_state IS NOT NULL GROUP BY seller_state HAVING count(*) > 1""",
)
def dq_unique(given: Given) -> DataFrame:
    return quality.repeated_values(given.staged("stg_olist_sellers"), "seller_state")


@check(
    "dq_accepted_values",
    """SELECT order_id, payment_sequential, payment_type FROM stg_olist_order_payments
       WHERE payment_type NOT IN
             ('credit_card', 'boleto', 'voucher', 'debit_card', 'not_defined')""",
)
def dq_accepted_values(given: Given) -> DataFrame:
    test = one("stg_olist_order_payments", "payment_type", "accepted_values")
    return quality.failing_rows(test, given.model(test.model)).select(
        "order_id", "payment_sequential", "payment_type"
    )


ORPHANS_SQL = """
    SELECT customer_id, count(*) AS n_rows FROM stg_olist_orders
    WHERE customer_id IS NOT NULL
      AND customer_id NOT IN (SELECT customer_id FROM stg_olist_customers)
    GROUP BY customer_id"""


def unknown_customers(given: Given) -> DataFrame:
    return quality.orphans(
        given.staged("stg_olist_orders"),
        "customer_id",
        given.staged("stg_olist_customers"),
        "customer_id",
    )


check("dq_relationships", ORPHANS_SQL)(unknown_customers)
check("join_anti_relationship", ORPHANS_SQL)(unknown_customers)


@check(
    "dq_expression_is_true",
    """SELECT order_id, order_item_id FROM stg_olist_order_items
       WHERE NOT (freight_value > 0)""",
)
def dq_expression_is_true(given: Given) -> DataFrame:
    test = quality.ExpressionIsTrue("stg_olist_order_items", "freight_value", "> 0")
    return quality.failing_rows(test, given.model(test.model)).select(
        "order_id", "order_item_id"
    )


@check(
    "dq_singular",
    """SELECT customer_unique_id, total_orders, delivered_orders, cancelled_orders
       FROM damaged_mart_olist_customer_orders
       WHERE delivered_orders + cancelled_orders > total_orders""",
)
def dq_singular(given: Given) -> DataFrame:
    test = one("mart_olist_customer_orders", "customer_unique_id", "singular")
    return quality.failing_rows(test, Models(given).damaged(test.model))


def failures_sql(test: quality.Test, prefix: str = "") -> str:
    column, model = test.column, prefix + test.model
    if isinstance(test, quality.Unique):
        return (
            f"SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL "
            f"GROUP BY {column} HAVING count(*) > 1)"
        )
    if isinstance(test, quality.Relationship):
        return (
            f"SELECT count(*) FROM {model} WHERE {column} IS NOT NULL AND {column} NOT IN "
            f"(SELECT {test.parent_column} FROM {prefix}{test.parent} "
            f"WHERE {test.parent_column} IS NOT NULL)"
        )
    if isinstance(test, quality.NotNull):
        condition = f"{column} IS NULL"
    elif isinstance(test, quality.AcceptedValues):
        condition = f"{column} NOT IN {test.values}"
    elif isinstance(test, quality.ExpressionIsTrue):
        condition = f"NOT ({column} {test.condition})"
    else:
        condition = test.condition
    return f"SELECT count(*) FROM {model} WHERE {condition}"


def report_sql(prefix: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{test.model}' AS model, '{test.column}' AS "column", '{test.name}' AS test,
            CAST(({failures_sql(test, prefix)}) AS BIGINT) AS failures"""
        for test in suite()
    )


REPORT_SQL = report_sql()


@check("dq_report", REPORT_SQL)
def dq_report(given: Given) -> DataFrame:
    models = Models(given).with_marts(*MART_NAMESPACES)
    return quality.quality_report(given.spark, models, suite())


@check("dq_report_damaged", report_sql(PREFIX))
def dq_report_damaged(given: Given) -> DataFrame:
    """The same tests over models in which each of them is broken by some rows."""
    models = Models(given).with_marts(*MART_NAMESPACES)
    broken = {name: models.damaged(name) for name in NOT_NULL}
    return quality.quality_report(given.spark, broken, suite())


class Models(dict):
    """Model name to DataFrame, built on first use; marts are stored, as in a build: those
    that are needed side by side."""

    def __init__(self, given: Given) -> None:
        super().__init__()
        self.given = given

    def __missing__(self, name: str) -> DataFrame:
        if name.startswith("stg_"):
            self[name] = self.given.staged(name)
        elif name == "mart_customer_orders_masked":
            self[name] = customer_orders_masked(self["mart_customer_orders"])
        else:
            self[name] = self.given.stored(self.given.mart(name))
        return self[name]

    def with_marts(self, *names: str) -> Models:
        """These marts are stored at the same time, so that none waits for the last tasks of another."""
        given = self.given
        self |= in_parallel(
            given.spark,
            {name: (lambda name=name: given.stored(given.mart(name))) for name in names},
        )
        return self

    def damaged(self, name: str) -> DataFrame:
        return damaged(name, self[name])


# role views

VIEWS = {
    "role_view_engineer": (ENGINEER, "marts", "mart_customer_orders", ""),
    "role_view_analyst_masked": (ANALYST, "marts", "mart_customer_orders_masked", ""),
    "role_view_analyst_customers": (
        ANALYST,
        "olist_marts",
        "mart_olist_customer_orders",
        " WHERE delivered_orders > 0",
    ),
    "role_view_analyst_sellers": (ANALYST, "olist_marts", "mart_olist_seller_performance", ""),
}


def governed(given: Given, *marts: str) -> Warehouse:
    """A warehouse that holds these marts."""
    warehouse = given.warehouse("governed")
    for mart in marts:
        warehouse.replace(given.mart(mart), MART_NAMESPACES[mart], mart)
    return warehouse


for _name, (_role, _layer, _table, _where) in VIEWS.items():
    check(_name, MODEL_SQL[_table] + _where)(
        lambda given, _role=_role, _layer=_layer, _table=_table: role_view(
            governed(given, _table.removesuffix("_masked")), _role, _layer, _table
        )
    )


@check("role_view_analyst_policy", POLICY_SQL)
def role_view_analyst_policy(given: Given) -> DataFrame:
    """What an analyst would see of the unmasked mart if it were granted by mistake."""
    return with_row_policy(given.mart("mart_customer_orders"), ANALYST, "mart_customer_orders")


# All that the analyst may read.
GRANTED = (
    ("marts", "mart_customer_orders_masked", ""),
    ("olist_marts", "mart_olist_customer_orders", " WHERE delivered_orders > 0"),
    ("olist_marts", "mart_olist_seller_performance", ""),
)
REFUSED = sorted(set(all_tables()) - {(layer, table) for layer, table, _ in GRANTED})


@check(
    "role_view_denied",
    " UNION ALL ".join(
        [
            f"SELECT '{layer}' AS layer, '{table}' AS table_name, false AS refused, "
            f"count(*) AS n_rows FROM ({MODEL_SQL[table]}{where}) AS seen"
            for layer, table, where in GRANTED
        ]
        + [f"SELECT '{layer}', '{table}', true, 0" for layer, table in REFUSED]
    ),
)
def role_view_denied(given: Given) -> DataFrame:
    """Every table of the warehouse asked for as the analyst: refused, or its rows."""
    warehouse = governed(given, *MART_NAMESPACES)
    refused, seen = [], []
    for layer, table in all_tables():
        try:
            view = role_view(warehouse, ANALYST, layer, table)
        except PermissionError:
            refused.append((layer, table))
            continue
        seen.append(
            view.agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(layer).alias("layer"),
                F.lit(table).alias("table_name"),
                F.lit(False).alias("refused"),
                "n_rows",
            )
        )
    found = given.spark.createDataFrame(refused, "layer string, table_name string").select(
        "*", F.lit(True).alias("refused"), F.lit(0).cast("bigint").alias("n_rows")
    )
    for counted in seen:
        found = found.unionByName(counted)
    return found
