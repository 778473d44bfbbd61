"""Raw tables of the warehouse, made from the test tables.

Every row of a test table is used. The gaps that the models must cope with come from
the data itself: suppliers are registered as customers who never order, customers as
sellers who never sell, orders of unstated priority belong to an unknown guest,
orders without line items were never paid, and pending orders have no review.

`sql.RAW` holds the same tables as SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmill.plans.marts import customer_orders_masked, mart
from marketmill.plans.staging import raw_table_of, staging
from marketmill.schemas import MULTI_LINE_TABLES
from marketmill.session import scratch_path
from marketmill.sources.csv_files import write_csv_table
from marketmill.sources.tables import Warehouse, in_parallel


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def padded(value: Column) -> Column:
    return F.concat(F.lit("  "), value, F.lit(" "))


def by_status(done: str, sent: str, other: Column | str) -> Column:
    other = F.lit(other) if isinstance(other, str) else other
    status = F.col("o_orderstatus")
    return F.when(status == "F", done).when(status == "O", sent).otherwise(other)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    def people(df: DataFrame, key: Column, name: str, nation: str, day: Column) -> DataFrame:
        nations = read(spark, sf_dir, "nation")
        return df.join(nations, F.col(nation) == F.col("n_nationkey")).select(
            key.alias("customer_id"),
            padded(F.split_part(name, F.lit("#"), F.lit(1))).alias("first_name"),
            padded(F.split_part(name, F.lit("#"), F.lit(2))).alias("last_name"),
            padded(F.concat(F.replace(name, F.lit("#"), F.lit(".")), F.lit("@Example.COM"))).alias(
                "email"
            ),
            padded(F.lower("n_name")).alias("country"),
            F.date_add(F.lit("1992-01-01").cast("date"), day.cast("int")).alias("created_at"),
        )

    buyers = people(
        read(spark, sf_dir, "customer"),
        F.col("c_custkey"),
        F.col("c_name"),
        "c_nationkey",
        F.col("c_custkey") % 1000,
    )
    visitors = people(
        read(spark, sf_dir, "supplier"),
        -F.col("s_suppkey") - 1,
        F.col("s_name"),
        "s_nationkey",
        F.col("s_suppkey") % 1000,
    )
    return buyers.unionByName(visitors)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    waiting = F.when(F.col("o_orderpriority") == "5-LOW", " Pending ").otherwise("Cancelled")
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        by_status(" Completed", "SHIPPED ", waiting).alias("status"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
    )


def olist_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    guest = F.col("o_orderpriority") == "4-NOT SPECIFIED"
    return read(spark, sf_dir, "orders").select(
        F.when(guest, F.concat(F.lit("guest-"), text("o_orderkey")))
        .otherwise(text("o_orderkey"))
        .alias("customer_id"),
        text("o_custkey").alias("customer_unique_id"),
        F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias(
            "customer_zip_code_prefix"
        ),
        padded(F.concat(F.lit("CITY "), "o_orderstatus")).alias("customer_city"),
        padded(F.lower("o_orderstatus")).alias("customer_state"),
    )


def olist_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    bought = F.col("o_orderdate").cast("timestamp_ntz")
    status = F.col("o_orderstatus")

    def later(interval: str) -> Column:
        return bought + F.expr(f"INTERVAL {interval}")

    return read(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("order_id"),
        text("o_orderkey").alias("customer_id"),
        by_status(" Delivered", "SHIPPED ", "canceled").alias("order_status"),
        bought.alias("order_purchase_timestamp"),
        F.when(status != "P", later("'1' HOUR")).alias("order_approved_at"),
        F.when(status != "P", later("'1' DAY")).alias("order_delivered_carrier_date"),
        F.when(status == "F", later("'7' DAY")).alias("order_delivered_customer_date"),
        later("'14' DAY").alias("order_estimated_delivery_date"),
    )


def olist_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    freight = (F.col("l_extendedprice") * F.col("l_tax")).cast("decimal(18,6)")
    return read(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        text("l_partkey").alias("product_id"),
        text("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("shipping_limit_date"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
        freight.cast("decimal(10,2)").alias("freight_value"),
    )


def olist_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    return read(spark, sf_dir, "lineitem").select(
        text("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(flag == "A", " Credit_Card")
        .when(flag == "N", "BOLETO ")
        .otherwise("Gift")
        .alias("payment_type"),
        F.col("l_linenumber").alias("payment_installments"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("payment_value"),
    )


def olist_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per order that left the shop, a second one for urgent orders."""
    reviewed = read(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    priority = F.col("o_orderpriority")
    said = F.concat(F.lit(' said "'), priority, F.lit('",\nthen left '))

    def review(df: DataFrame, mark: str, score: Column, days: int) -> DataFrame:
        written = F.col("o_orderdate").cast("timestamp_ntz") + F.expr(f"INTERVAL '{days}' DAY")
        return df.select(
            F.concat(F.lit(mark), text("o_orderkey")).alias("review_id"),
            text("o_orderkey").alias("order_id"),
            score.cast("int").alias("review_score"),
            padded(F.lower(priority)).alias("review_comment_title"),
            said.alias("review_comment_message"),
            written.alias("review_creation_date"),
            (written + F.expr("INTERVAL '1' DAY")).alias("review_answer_timestamp"),
        )

    digit = F.substring(priority, 1, 1).cast("int")
    unscored = (priority == "5-LOW") & (F.col("o_orderstatus") == "O")
    first = review(reviewed, "a", F.when(~unscored, digit), 8)
    second = review(reviewed.where(priority == "1-URGENT"), "b", 6 - digit, 9)
    return first.unionByName(second)


def olist_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        text("p_partkey").alias("product_id"),
        padded(F.col("p_type")).alias("product_category_name"),
        F.length("p_name").alias("product_name_lenght"),
        F.when(size <= 40, size).alias("product_description_lenght"),
        size.alias("product_photos_qty"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("product_weight_g"),
        *(
            size.cast("decimal(18,4)").alias(f"product_{side}_cm")
            for side in ("length", "height", "width")
        ),
    )


def olist_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sellers(table: str, key: Column, nation: str) -> DataFrame:
        place = F.lpad(text(nation), 5, "0")
        return read(spark, sf_dir, table).select(
            key.alias("seller_id"),
            place.alias("seller_zip_code_prefix"),
            padded(F.concat(F.lit("CITY "), text(nation))).alias("seller_city"),
            padded(F.concat(F.lit("s"), text(nation))).alias("seller_state"),
        )

    return sellers("supplier", text("s_suppkey"), "s_nationkey").unionByName(
        sellers("customer", F.concat(F.lit("c"), text("c_custkey")), "c_nationkey")
    )


def olist_geolocation(spark: SparkSession, sf_dir: str) -> DataFrame:
    balance = F.col("c_acctbal").cast("decimal(10,2)").cast("decimal(18,14)")
    return read(spark, sf_dir, "customer").select(
        F.lpad(text("c_nationkey"), 5, "0").alias("geolocation_zip_code_prefix"),
        balance.alias("geolocation_lat"),
        (-balance).cast("decimal(18,14)").alias("geolocation_lng"),
        padded(F.col("c_mktsegment")).alias("geolocation_city"),
        padded(F.lower(F.substring("c_mktsegment", 1, 2))).alias("geolocation_state"),
    )


def olist_product_category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = read(spark, sf_dir, "part").select("p_type").distinct()
    return kinds.select(
        padded(F.col("p_type")).alias("product_category_name"),
        padded(F.lower("p_type")).alias("product_category_name_english"),
    )


RAW_TABLES = {
    builder.__name__: builder
    for builder in (
        raw_customers,
        raw_orders,
        olist_customers,
        olist_orders,
        olist_order_items,
        olist_order_payments,
        olist_order_reviews,
        olist_products,
        olist_sellers,
        olist_geolocation,
        olist_product_category_translation,
    )
}


def all_raw(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_TABLES.items()}


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One catalog document per row of `documents`.

    English and German documents count as models, the others as tests. The language
    column is described with white space around it, the source column is blank where
    the document has no label and the last column lacks a description altogether.
    """
    docs = read(spark, sf_dir, "documents")
    labels = read(spark, sf_dir, "labels")
    name = F.concat(F.lit("doc_"), text("doc_id"))

    def described(value: Column) -> Column:
        return F.struct(value.alias("description"))

    node = F.struct(
        F.when(F.col("lang").isin("en", "de"), "model").otherwise("test").alias("resource_type"),
        name.alias("name"),
        F.col("text").alias("description"),
        F.create_map(
            F.lit("lang"),
            described(F.concat(F.lit("\t "), "lang", F.lit(" \n"))),
            F.lit("source"),
            described(F.when(F.col("quality").isNull(), "  ").otherwise(F.col("source"))),
            F.lit("n_chars"),
            described(F.lit(None).cast("string")),
        ).alias("columns"),
    )
    nodes = F.create_map(F.concat(F.lit("node."), name), node)
    return docs.join(labels, "doc_id", "left").select(nodes.alias("nodes"))


def manifest_files(spark: SparkSession, sf_dir: str) -> str:
    """The same documents as JSON files, one per line; returns their folder."""
    path = scratch_path(spark, "manifests")
    manifests(spark, sf_dir).select(F.to_json(F.struct("nodes"))).write.text(path)
    return path


def vector_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`embeddings` as a catalog: odd labels are columns, even ones models."""
    label = F.col("label")
    odd = label % 2 == 1
    return read(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.when(odd, "column").otherwise("model").alias("source"),
        F.concat(F.lit("label_"), label.cast("string")).alias("model_name"),
        F.when(odd, F.concat(F.lit("vec_"), text("vec_id"))).alias("column_name"),
        F.concat(F.lit("vector "), text("vec_id")).alias("description"),
        "embedding",
    )


def first_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question per label: the vector with the lowest id under it."""
    return read(spark, sf_dir, "embeddings").groupBy(F.col("label").alias("question_id")).agg(
        F.min_by("embedding", "vec_id").alias("embedding")
    )


def question(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector with the lowest id."""
    row = read(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").first()
    return [float(x) for x in row["embedding"]]


def event_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as catalog rows with many rows per key; views are described as models."""
    viewed = F.col("event_type") == "view"
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(viewed, "model").otherwise("column").alias("source"),
        F.concat(F.lit("user_"), text("user_id")).alias("model_name"),
        F.when(~viewed, F.col("event_type")).alias("column_name"),
        F.concat(F.lit("event "), text("event_id"), F.lit(" "), "props").alias("description"),
        F.col("ts").cast("timestamp_ntz").alias("updated_at"),
    )


def is_old() -> Column:
    """Morning events are what the catalog holds, the others arrive as a batch."""
    return F.hour("updated_at") < 12


class Given:
    """The models over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return RAW_TABLES[name](self.spark, self.sf_dir)

    def staged(self, model: str) -> DataFrame:
        return staging(model, self.raw(raw_table_of(model)))

    def mart(self, name: str) -> DataFrame:
        if name == "mart_customer_orders_masked":
            return customer_orders_masked(self.mart("mart_customer_orders"))
        return mart(name, self.staged)

    def model(self, name: str) -> DataFrame:
        return self.staged(name) if name.startswith("stg_") else self.mart(name)

    def stored(self, df: DataFrame) -> DataFrame:
        """`df` as a written table in the shared folder, to be read many times."""
        path = scratch_path(self.spark, "stored")
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def warehouse(self, name: str) -> Warehouse:
        """A warehouse of its own below the shared folder."""
        root = scratch_path(self.spark, name)
        return Warehouse(self.spark, root, prefix=f"{root.rsplit('/', 1)[1].replace('-', '_')}_")

    def csv_files(self, files: dict[str, str], root: str | None = None) -> str:
        """The raw tables as CSV landing files, in a new folder or `root`; returns the folder.

        All but those with line breaks in quotes are compressed parts.
        """
        root = (root or scratch_path(self.spark, "landing")).rstrip("/")

        def write(file: str, table: str) -> None:
            plain = table in MULTI_LINE_TABLES
            write_csv_table(self.raw(table), f"{root}/{file}", compressed=not plain)

        in_parallel(
            self.spark,
            {
                file: (lambda file=file, table=table: write(file, table))
                for file, table in files.items()
            },
        )
        return root
