"""Loads, sinks, catalog, retrieval, training and the whole build."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmill.checks.inputs import (
    Given,
    event_catalog,
    first_vectors,
    is_old,
    manifest_files,
    manifests,
    question,
    vector_catalog,
)
from marketmill.checks.models import MODEL_SQL
from marketmill.checks.registry import check
from marketmill.checks.rules import REPORT_SQL
from marketmill.operators.descriptions import (
    catalog_rows,
    exploded_columns,
    exploded_nodes,
    models_only,
)
from marketmill.operators.embed import DIMENSIONS, embedded, hashed_words
from marketmill.operators.lists import VectorLists
from marketmill.operators.nearest import build_lists, nearest_for_each, nearest_in_lists
from marketmill.operators.upsert import upsert
from marketmill.plans import training
from marketmill.plans.build import MART_NAMESPACES, build_all, staged_views, stored_marts
from marketmill.plans.catalog import (
    catalog_keys,
    context,
    deduplicated,
    index_catalog,
    retrieve,
)
from marketmill.plans.staging import staging
from marketmill.schemas import MARKETPLACE_FILES, MULTI_LINE_TABLES, RAW_COLUMNS, SEED_FILES
from marketmill.session import scratch_path
from marketmill.sources.csv_files import (
    load_csv_tables,
    read_csv_tables,
    remote_root,
    require_files,
    source_root,
)
from marketmill.sources.manifests import read_manifests
from marketmill.sources.parted import KeyedTable
from marketmill.sources.tables import as_views

RUN_AT = datetime(2024, 6, 1, 12, 0, 0)


def files_of(*tables: str) -> dict[str, str]:
    every = MARKETPLACE_FILES | SEED_FILES
    return {file: table for file, table in every.items() if table in tables}


def row_counts(given: Given, counts: dict[str, int]) -> DataFrame:
    return given.spark.createDataFrame(sorted(counts.items()), "table_name string, n_rows bigint")


# sources


REVIEW_RANGE = 100_000  # bytes; a production range is a multiple of a storage block


@check(
    "csv_ingest",
    """SELECT review_id, order_id, CAST(review_score AS DOUBLE) AS review_score,
              review_comment_title, review_comment_message,
              CAST(review_creation_date AS VARCHAR) AS review_creation_date,
              CAST(review_answer_timestamp AS VARCHAR) AS review_answer_timestamp
       FROM olist_order_reviews""",
    gaps=("review_score",),
)
def csv_ingest(given: Given) -> DataFrame:
    """All nine files, through CSV text and back; shown is the one with line breaks, which
    is cut into ranges here. `csv_ingest_<table>` shows each of the others."""
    warehouse = given.warehouse("ingest")
    root = given.csv_files(MARKETPLACE_FILES)
    load_csv_tables(warehouse, root, MARKETPLACE_FILES, range_bytes=REVIEW_RANGE)
    return warehouse.read("raw", "olist_order_reviews")


def ingested(table: str):
    """A whole table after its way through CSV text and the load."""

    def run(given: Given) -> DataFrame:
        warehouse, files = given.warehouse("ingest"), files_of(table)
        load_csv_tables(warehouse, given.csv_files(files), files)
        return warehouse.read("raw", table)

    return run


# Kinds of columns that are compared as doubles or as text; `gaps` hold NULLs.
SHOWN_AS = {"decimal": "DOUBLE", "timestamp": "VARCHAR", "date": "VARCHAR"}
GAPS = {"olist_products": ("product_description_lenght",)}


def shown_sql(table: str) -> str:
    parts = []
    for name, kind in RAW_COLUMNS[table]:
        target = next((t for start, t in SHOWN_AS.items() if kind.startswith(start)), None)
        target = "DOUBLE" if name in GAPS.get(table, ()) else target
        parts.append(f"CAST({name} AS {target}) AS {name}" if target else name)
    return f"SELECT {', '.join(parts)} FROM {table}"


for name in (*MARKETPLACE_FILES.values(), *SEED_FILES.values()):
    if name not in MULTI_LINE_TABLES:
        check(f"csv_ingest_{name}", shown_sql(name), GAPS.get(name, ()))(ingested(name))


@check(
    "csv_zip_as_string",
    """SELECT seller_id, seller_zip_code_prefix FROM olist_sellers""",
)
def csv_zip_as_string(given: Given) -> DataFrame:
    files = files_of("olist_sellers")
    frames = read_csv_tables(given.spark, given.csv_files(files), files)
    return frames["olist_sellers"].select("seller_id", "seller_zip_code_prefix")


@check(
    "csv_require_files",
    """SELECT product_category_name, 'olist_orders_dataset.csv' AS missing
       FROM olist_product_category_translation""",
)
def csv_require_files(given: Given) -> DataFrame:
    """Rows of the file that is there, with the name of the one that is not."""
    there = files_of("olist_product_category_translation")
    root = given.csv_files(there)
    wanted = there | files_of("olist_orders")
    try:
        require_files(given.spark, root, wanted)
        missing = ""
    except FileNotFoundError as error:
        missing = str(error).rsplit(": ", 1)[1]
    frames = read_csv_tables(given.spark, root, there)
    return frames["olist_product_category_translation"].select(
        "product_category_name", F.lit(missing).alias("missing")
    )


@check(
    "csv_remote_source",
    "SELECT product_id, product_photos_qty FROM olist_products",
)
def csv_remote_source(given: Given) -> DataFrame:
    """The local folder lacks the file, so the bucket's copy is read in place."""
    files = files_of("olist_products")
    bucket = scratch_path(given.spark, "bucket")  # stands in for the bucket
    given.csv_files(files, remote_root(bucket))
    root = source_root(given.spark, scratch_path(given.spark, "empty"), files, bucket)
    frames = read_csv_tables(given.spark, root, files)
    return frames["olist_products"].select("product_id", "product_photos_qty")


COUNTS_SQL = " UNION ALL ".join(
    f"SELECT '{table}' AS table_name, count(*) AS n_rows FROM {table}"
    for table in MARKETPLACE_FILES.values()
)


@check("load_row_counts", COUNTS_SQL)
def load_row_counts(given: Given) -> DataFrame:
    root = given.csv_files(MARKETPLACE_FILES)
    return row_counts(
        given, load_csv_tables(given.warehouse("counts"), root, MARKETPLACE_FILES)
    )


@check(
    "reload_idempotent",
    """SELECT order_id, payment_sequential, payment_type, payment_installments,
              CAST(payment_value AS DOUBLE) AS payment_value
       FROM olist_order_payments""",
)
def reload_idempotent(given: Given) -> DataFrame:
    """The table after loading the same file twice."""
    files = files_of("olist_order_payments")
    warehouse, root = given.warehouse("reload"), given.csv_files(files)
    first = load_csv_tables(warehouse, root, files)
    second = load_csv_tables(warehouse, root, files)
    if first != second:
        raise AssertionError(f"{first} became {second}")
    return warehouse.read("raw", "olist_order_payments")


@check("namespace_create", "SELECT customer_id, customer_unique_id FROM olist_customers")
def namespace_create(given: Given) -> DataFrame:
    """Created twice without complaint, then used."""
    warehouse = given.warehouse("spaces")
    warehouse.create_namespace("raw")
    warehouse.create_namespace("raw")
    warehouse.replace(given.raw("olist_customers"), "raw", "olist_customers")
    return warehouse.read("raw", "olist_customers").select("customer_id", "customer_unique_id")


@check(
    "seed_load",
    """SELECT a.customer_id, a.first_name, a.email, CAST(b.order_id AS DOUBLE) AS order_id,
              b.status, CAST(b.amount AS DOUBLE) AS amount
       FROM stg_customers a LEFT JOIN stg_orders b ON a.customer_id = b.customer_id""",
    gaps=("order_id",),
)
def seed_load(given: Given) -> DataFrame:
    frames = read_csv_tables(given.spark, given.csv_files(SEED_FILES), SEED_FILES)
    customers = staging("stg_customers", frames["raw_customers"])
    orders = staging("stg_orders", frames["raw_orders"])
    return customers.join(orders, "customer_id", "left").select(
        "customer_id", "first_name", "email", "order_id", "status", "amount"
    )


@check(
    "table_scan",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
)
def table_scan(given: Given) -> DataFrame:
    return given.table("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )


@check(
    "json_manifest_scan",
    "SELECT node_id, resource_type, name, description FROM nodes",
)
def json_manifest_scan(given: Given) -> DataFrame:
    path = manifest_files(given.spark, given.sf_dir)
    scanned = read_manifests(given.spark, path, multi_line=False)
    return exploded_nodes(scanned).select("node_id", "resource_type", "name", "description")


@check(
    "column_pruned_read",
    """SELECT customer_id, CAST(total_orders AS DOUBLE) AS total_orders, avg_order_value,
              CAST(completed_orders AS DOUBLE) AS completed_orders,
              CAST(cancelled_orders AS DOUBLE) AS cancelled_orders,
              CAST(lifetime_value AS DOUBLE) AS lifetime_value
       FROM mart_customer_orders""",
)
def column_pruned_read(given: Given) -> DataFrame:
    mart = given.stored(given.mart("mart_customer_orders"))
    return training.training_rows(mart, training.CUSTOMERS)


# sinks


@check("view_materialise", MODEL_SQL["stg_orders"])
def view_materialise(given: Given) -> DataFrame:
    as_views({"stg_orders": given.staged("stg_orders")}, prefix="checked_")
    return given.spark.table("checked_stg_orders")


@check("table_materialise", MODEL_SQL["mart_olist_customer_orders"])
def table_materialise(given: Given) -> DataFrame:
    """Built twice; the second build replaces the first."""
    warehouse = given.warehouse("marts")
    for _ in range(2):
        warehouse.replace(
            given.mart("mart_olist_customer_orders"), "olist_marts", "mart_olist_customer_orders"
        )
    return warehouse.read("olist_marts", "mart_olist_customer_orders")


# catalog

CATALOG_SQL = """
    SELECT 'model' AS source, name AS model_name, NULL AS column_name,
           trim(description, ' ' || chr(9) || chr(10) || chr(13)) AS description
    FROM nodes
    WHERE resource_type = 'model' AND trim(description, ' ' || chr(9) || chr(10) || chr(13)) <> ''
    UNION ALL
    SELECT 'column', name, column_name,
           name || '.' || column_name || ': '
               || trim(column_description, ' ' || chr(9) || chr(10) || chr(13))
    FROM node_columns
    WHERE resource_type = 'model'
      AND trim(column_description, ' ' || chr(9) || chr(10) || chr(13)) <> ''"""


@check("catalog_extract", CATALOG_SQL)
def catalog_extract(given: Given) -> DataFrame:
    return catalog_rows(manifests(given.spark, given.sf_dir))


@check(
    "union_docs",
    """SELECT name AS model_name, NULL AS column_name FROM nodes WHERE resource_type = 'model'
       UNION ALL
       SELECT name, column_name FROM node_columns WHERE resource_type = 'model'""",
)
def union_docs(given: Given) -> DataFrame:
    models = models_only(exploded_nodes(manifests(given.spark, given.sf_dir)))
    of_models = models.select(
        F.col("name").alias("model_name"), F.lit(None).cast("string").alias("column_name")
    )
    of_columns = exploded_columns(models).select(
        F.col("name").alias("model_name"), "column_name"
    )
    return of_models.unionByName(of_columns)


UPSERT_SQL = """
    SELECT a.id, a.source, a.model_name, a.column_name,
           CASE WHEN b.k IS NULL THEN a.description ELSE b.description END AS description,
           CAST(CASE WHEN b.k IS NULL THEN a.updated_at ELSE b.updated_at END AS VARCHAR)
               AS updated_at
    FROM held a LEFT JOIN news b ON a.k = b.k
    UNION ALL
    SELECT (SELECT max(id) FROM held) + row_number() OVER (ORDER BY md5(k || '|'), k),
           source, model_name, column_name, description, CAST(updated_at AS VARCHAR)
    FROM news WHERE k NOT IN (SELECT k FROM held)"""


def after_batch(given: Given) -> DataFrame:
    """The catalog of morning events after a batch of all the others, last one winning."""
    rows = event_catalog(given.spark, given.sf_dir)
    return upsert(
        deduplicated(rows.where(is_old())),
        rows.where(~is_old()),
        catalog_keys(),
        ("description", "updated_at"),
        "id",
        [F.col("updated_at").desc(), F.col("id").desc()],
    )


check("upsert_by_key", UPSERT_SQL)(after_batch)


@check("upsert", UPSERT_SQL)
def upsert_stored(given: Given) -> DataFrame:
    """The same, with the table replaced by its own successor."""
    warehouse = given.warehouse("catalog")
    rows = event_catalog(given.spark, given.sf_dir)
    warehouse.replace(deduplicated(rows.where(is_old())), "catalog", "events")
    changed = upsert(
        warehouse.read("catalog", "events"),
        rows.where(~is_old()),
        catalog_keys(),
        ("description", "updated_at"),
        "id",
        [F.col("updated_at").desc(), F.col("id").desc()],
    )
    warehouse.replace(changed, "catalog", "events")
    return warehouse.read("catalog", "events")


@check(
    "join_in_subquery",
    """SELECT id FROM event_rows WHERE id NOT IN (
           SELECT id FROM (
               SELECT id, row_number() OVER (
                   PARTITION BY source, model_name, ifnull(column_name, '')
                   ORDER BY updated_at DESC, id DESC) AS place
               FROM event_rows) WHERE place > 1)""",
)
def join_in_subquery(given: Given) -> DataFrame:
    return deduplicated(event_catalog(given.spark, given.sf_dir)).select("id")


# vectors


def word_figures(df: DataFrame, text: str) -> DataFrame:
    """What another engine can tell of hashed words: their size, their length, and that no
    more places are used than there are different words."""
    words = F.array_distinct(F.split(F.lower(text), r"\s"))
    used = F.size(F.filter("embedding", lambda x: x != 0))
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    return df.select(
        *(name for name in df.columns if name not in ("embedding", text)),
        F.size("embedding").alias("dimensions"),
        F.round(F.sqrt(squares), 3).alias("norm"),
        F.size(words).cast("bigint").alias("words"),
        used.between(1, F.size(words)).alias("places_fit"),
    )


def word_figures_sql(columns: str, text: str, source: str) -> str:
    """The same figures; the last must hold for every text."""
    words = f"list_distinct(string_split_regex(lower({text}), '[ \\t\\n\\x0B\\f\\r]'))"
    return f"""SELECT {columns}, {DIMENSIONS} AS dimensions, 1.0::DOUBLE AS norm,
                      len({words})::BIGINT AS words, len({words}) > 0 AS places_fit
               FROM {source}"""


@check(
    "embed_batch",
    word_figures_sql("source, model_name, column_name", "description", f"({CATALOG_SQL})"),
)
def embed_batch(given: Given) -> DataFrame:
    rows = catalog_rows(manifests(given.spark, given.sf_dir))
    return word_figures(hashed_words(rows), "description")


@check(
    "embed_batch_external",
    """SELECT name AS model_name, length(description) AS n_chars
       FROM nodes""",
)
def embed_batch_external(given: Given) -> DataFrame:
    """Batches through an outside embedder; this one measures the texts."""
    nodes = exploded_nodes(manifests(given.spark, given.sf_dir)).select("name", "description")
    vectors = embedded(nodes, lambda texts: [[float(len(text))] for text in texts])
    return vectors.select(
        F.col("name").alias("model_name"),
        F.col("embedding")[0].cast("bigint").alias("n_chars"),
    )


@check(
    "embed_query",
    word_figures_sql("conv_id, turn, role", "text", "conversations WHERE text IS NOT NULL"),
)
def embed_query(given: Given) -> DataFrame:
    """The texts of all conversations as vectors."""
    asked = given.table("conversations").where("text IS NOT NULL")
    vectors = hashed_words(asked, text="text")
    return word_figures(vectors.select("conv_id", "turn", "role", "text", "embedding"), "text")


TOP_SQL = """
    SELECT source, model_name, column_name, description,
           round(list_dot_product(v, q) / (len * q_len), 6) AS similarity
    FROM lengths, (SELECT v AS q, len AS q_len FROM lengths ORDER BY id LIMIT 1)
    ORDER BY list_dot_product(v, q) / (len * q_len) DESC NULLS LAST, id LIMIT 5"""


def top_five(given: Given) -> DataFrame:
    hits = retrieve(
        vector_catalog(given.spark, given.sf_dir), question(given.spark, given.sf_dir)
    )
    return hits.withColumn("similarity", F.round("similarity", 6))


check("topk_cosine", TOP_SQL)(top_five)
check("retrieve_topk", TOP_SQL)(top_five)


HITS_SQL = """
    SELECT * FROM (
        SELECT q.label AS question_id, row_number() OVER (
                   PARTITION BY q.label
                   ORDER BY list_dot_product(a.v, q.v) / (a.len * q.len) DESC, a.id) AS rank,
               round(list_dot_product(a.v, q.v) / (a.len * q.len), 6) AS similarity, a.id,
               a.source, a.model_name, a.column_name, a.description
        FROM lengths a,
             (SELECT * FROM lengths WHERE id IN (SELECT min(id) FROM lengths GROUP BY label)) q)
    WHERE rank <= 5"""


def hits_of_labels(given: Given) -> DataFrame:
    """The five nearest vectors of each label's question."""
    catalog = vector_catalog(given.spark, given.sf_dir)
    return nearest_for_each(catalog, first_vectors(given.spark, given.sf_dir))


@check(
    "retrieve_topk_many",
    f"SELECT question_id, rank, similarity, id FROM ({HITS_SQL})",
)
def retrieve_topk_many(given: Given) -> DataFrame:
    return hits_of_labels(given).select(
        "question_id",
        F.col("rank").cast("bigint").alias("rank"),
        F.round("similarity", 6).alias("similarity"),
        "id",
    )


@check(
    "context_build",
    f"""SELECT question_id, string_agg('- [' || source || '] ' || model_name
                || ifnull('.' || column_name, '') || ': ' || description,
               chr(10) ORDER BY rank) AS context
        FROM ({HITS_SQL}) GROUP BY question_id""",
)
def context_build(given: Given) -> DataFrame:
    described = vector_catalog(given.spark, given.sf_dir).drop("embedding")
    return context(hits_of_labels(given).join(described, "id"), by="question_id")


@check("vector_ivf", TOP_SQL)
def vector_ivf(given: Given) -> DataFrame:
    """All lists probed, which is exact; fewer are measured in the tests."""
    path = scratch_path(given.spark, "lists")
    index = build_lists(vector_catalog(given.spark, given.sf_dir), path)
    query = question(given.spark, given.sf_dir)
    hits = nearest_in_lists(given.spark, index, query, probes=len(index.centers))
    return hits.select(
        "source",
        "model_name",
        "column_name",
        "description",
        F.round("similarity", 6).alias("similarity"),
    )


@check(
    "vector_lists",
    f"SELECT question_id, rank, similarity, id FROM ({HITS_SQL})",
)
def vector_lists(given: Given) -> DataFrame:
    """Lists fitted to half of the vectors; the others and changed ones come later."""
    rows = vector_catalog(given.spark, given.sf_dir)
    later = (F.col("id") % 2 == 1) | (F.col("id") % 10 == 0)
    stale = F.when(F.col("id") % 10 == 0, F.transform("embedding", lambda x: -x)).otherwise(F.col("embedding"))
    index = VectorLists(given.warehouse("lists"), "search", "vectors", rows.schema)
    index.build(rows.where("id % 2 = 0").withColumn("embedding", stale))
    index.upsert(rows.where(later), [F.col("description")])
    hits = index.nearest_for_each(first_vectors(given.spark, given.sf_dir), len(index.centers()))
    return hits.select(
        "question_id",
        F.col("rank").cast("bigint").alias("rank"),
        F.round("similarity", 6).alias("similarity"),
        "id",
    )


@check(
    "vector_recall",
    """SELECT id AS question_id, least(5, (SELECT count(*) FROM lengths)) AS wanted,
              least(5, (SELECT count(*) FROM lengths)) AS found_in_all, true AS more_find_more,
              true AS itself_in_one
       FROM lengths WHERE id % 20 = 0""",
)
def vector_recall(given: Given) -> DataFrame:
    """A set of vectors as questions against all: exact hits found by 1, 3 and all lists.

    Its own list holds a vector, so the closest list alone finds at least that.
    """
    rows = vector_catalog(given.spark, given.sf_dir)
    index = VectorLists(given.warehouse("recall"), "search", "vectors", rows.schema)
    index.build(rows)
    every = len(index.centers())
    asked = rows.where("id % 20 = 0").select(F.col("id").alias("question_id"), "embedding")
    recalled = index.recall(asked, [1, 3, every]).groupBy("question_id")
    found = recalled.pivot("probes", [1, 3, every]).sum("found")
    one, three, whole = (F.col(str(n)) for n in (1, 3, every))
    total = rows.count()
    return found.select(
        "question_id",
        F.lit(min(5, total)).cast("bigint").alias("wanted"),
        whole.alias("found_in_all"),
        ((one <= three) & (three <= whole)).alias("more_find_more"),
        (one >= 1).alias("itself_in_one"),
    )


@check("upsert_bucketed", UPSERT_SQL)
def upsert_bucketed(given: Given) -> DataFrame:
    """The same update, of a table in key buckets."""
    rows = event_catalog(given.spark, given.sf_dir)
    table = KeyedTable(given.warehouse("buckets"), "catalog", "events", rows.schema, catalog_keys(), buckets=32)
    table.replace(deduplicated(rows.where(is_old())))
    table.upsert(
        rows.where(~is_old()),
        ("description", "updated_at"),
        [F.col("updated_at").desc(), F.col("id").desc()],
    )
    return table.read()


@check(
    "catalog_index",
    f"""SELECT source, model_name, column_name, description,
               '2024-06-01 12:00:00' AS updated_at FROM ({CATALOG_SQL})""",
)
def catalog_index(given: Given) -> DataFrame:
    """Documents to catalog, indexed twice: the second run updates in place."""
    path = manifest_files(given.spark, given.sf_dir)
    warehouse = given.warehouse("index")
    for _ in range(2):
        index_catalog(warehouse, path, hashed_words, RUN_AT, multi_line=False)
    return warehouse.read("catalog", "catalog_embeddings").select(
        "source", "model_name", "column_name", "description", "updated_at"
    )


# training


@check(
    "ml_features",
    """SELECT customer_id, CAST(total_orders AS DOUBLE) AS f0, avg_order_value AS f1,
              CAST(completed_orders AS DOUBLE) AS f2, CAST(cancelled_orders AS DOUBLE) AS f3,
              CAST(lifetime_value AS DOUBLE) AS lifetime_value
       FROM mart_customer_orders""",
)
def ml_features(given: Given) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    rows = training.training_rows(given.mart("mart_customer_orders"), training.CUSTOMERS)
    values = vector_to_array("features")
    return training.with_features(rows, training.CUSTOMERS).select(
        "customer_id", *(values[i].alias(f"f{i}") for i in range(4)), "lifetime_value"
    )


@check(
    "ml_split",
    """SELECT customer_id, row_number() OVER (ORDER BY md5(customer_id || '|42'), customer_id)
              <= greatest(1, CAST(floor((SELECT count(*) FROM mart_customer_orders) * 0.2)
                             AS BIGINT)) AS is_test
       FROM mart_customer_orders""",
)
def ml_split(given: Given) -> DataFrame:
    mart = given.stored(given.mart("mart_customer_orders"))
    rows = training.training_rows(mart, training.CUSTOMERS)
    return training.split(rows, training.CUSTOMERS).select("customer_id", "is_test")


@check(
    "ml_split_marketplace",
    """SELECT customer_unique_id,
              row_number() OVER (ORDER BY md5(customer_unique_id || '|42'), customer_unique_id)
              <= CAST(ceil((SELECT count(*) FROM mart_olist_customer_orders) * 0.2) AS BIGINT)
                  AS is_test
       FROM mart_olist_customer_orders""",
)
def ml_split_marketplace(given: Given) -> DataFrame:
    mart = given.stored(given.mart("mart_olist_customer_orders"))
    rows = training.training_rows(mart, training.MARKETPLACE)
    return training.split(rows, training.MARKETPLACE).select("customer_unique_id", "is_test")


def trained(given: Given, name: str, experiment: training.Experiment) -> training.Run:
    return training.train(given.stored(given.mart(name)), experiment)


VARYING_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS feature, count(DISTINCT {name}) > 1 AS varies FROM mart_customer_orders"
    for name in training.CUSTOMERS.features
)


@check(
    "ml_fit",
    f"SELECT feature, varies, true AS share, 1.0::DOUBLE AS total FROM ({VARYING_SQL})",
)
def ml_fit(given: Given) -> DataFrame:
    """Weights of the features in the fitted forest: shares of one, none for a constant."""
    mart = given.stored(given.mart("mart_customer_orders"))
    run = training.train(mart, training.CUSTOMERS)
    weights = run.model.featureImportances.toArray().tolist()
    names = training.CUSTOMERS.features
    distinct = mart.select(*(F.count_distinct(name) for name in names)).first()
    rows = [
        (name, n > 1, 0 <= weight <= (1 if n > 1 else 0), round(sum(weights), 9))
        for name, n, weight in zip(names, distinct, weights, strict=True)
    ]
    return given.spark.createDataFrame(
        rows, "feature string, varies boolean, share boolean, total double"
    )


TEST_SQL = """
    SELECT customer_unique_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value FROM (
        SELECT customer_unique_id, lifetime_value,
               row_number() OVER (ORDER BY md5(customer_unique_id || '|42'), customer_unique_id)
                   <= CAST(ceil((SELECT count(*) FROM mart_olist_customer_orders) * 0.2) AS BIGINT)
                   AS is_test
        FROM mart_olist_customer_orders) WHERE is_test"""


@check(
    "ml_predict",
    f"SELECT customer_unique_id, lifetime_value, true AS within FROM ({TEST_SQL})",
)
def ml_predict(given: Given) -> DataFrame:
    """The customers of the test part; a forest's predictions are means of training values,
    so they lie between the least and the largest of those."""
    mart = given.stored(given.mart("mart_olist_customer_orders"))
    run = training.train(mart, training.MARKETPLACE)
    rows = training.split(training.training_rows(mart, training.MARKETPLACE), training.MARKETPLACE)
    target = F.col("lifetime_value").cast("double")
    bounds = rows.where("NOT is_test").select(F.min(target).alias("least"), F.max(target).alias("most"))
    least, most = bounds.first()
    slack = 1e-9 * max(abs(least), abs(most))
    within = F.col("prediction").between(least - slack, most + slack)
    return run.predictions.select(
        "customer_unique_id", target.alias("lifetime_value"), within.alias("within")
    )


@check(
    "ml_metrics",
    """SELECT unnest(['mae', 'r2']) AS metric, n - ceil(n * 0.2) AS train_rows,
              ceil(n * 0.2) AS test_rows, 0.0::DOUBLE AS apart
       FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM mart_olist_customer_orders)""",
)
def ml_metrics(given: Given) -> DataFrame:
    """Errors of the test part, recomputed from the predictions by hand."""
    run = trained(given, "mart_olist_customer_orders", training.MARKETPLACE)
    truth = F.col("lifetime_value").cast("double")
    shown = run.predictions.select(truth.alias("t"), F.col("prediction").alias("p"))
    mae, squares, mean, squared, n = shown.select(
        F.avg(F.abs(F.col("t") - F.col("p"))), F.sum((F.col("t") - F.col("p")) ** 2),
        F.avg("t"), F.sum(F.col("t") * F.col("t")), F.count("*"),
    ).first()
    spread = squared - n * mean * mean
    known = run.metrics
    r2 = 1 - squares / spread if spread else known["r2"]
    rows = [
        (name, known["train_rows"], known["test_rows"], abs(round(known[name] - found, 6)))
        for name, found in (("mae", mae), ("r2", r2))
    ]
    return given.spark.createDataFrame(
        rows, "metric string, train_rows double, test_rows double, apart double"
    )


@check(
    "run_record_sink",
    """SELECT 'lifetime_value_prediction' AS experiment, '100' AS n_estimators,
              n - greatest(1, floor(n * 0.2)) AS train_rows, greatest(1, floor(n * 0.2)) AS test_rows
       FROM (SELECT CAST(count(*) AS DOUBLE) AS n FROM mart_customer_orders), range(2)""",
)
def run_record_sink(given: Given) -> DataFrame:
    """Two runs, two records."""
    warehouse = given.warehouse("runs")
    mart = given.stored(given.mart("mart_customer_orders"))
    for _ in range(2):
        training.train_and_record(warehouse, mart, training.CUSTOMERS, RUN_AT)
    return warehouse.read("ml", "ml_runs").select(
        "experiment",
        F.col("params")["n_estimators"].alias("n_estimators"),
        F.col("metrics")["train_rows"].alias("train_rows"),
        F.col("metrics")["test_rows"].alias("test_rows"),
    )


@check(
    "model_save",
    """SELECT customer_id, CAST(lifetime_value AS DOUBLE) AS lifetime_value, true AS as_fitted
       FROM mart_customer_orders""",
)
def model_save(given: Given) -> DataFrame:
    """Customers scored by a model that was stored and loaded again, beside the one fitted."""
    from pyspark.ml.regression import RandomForestRegressionModel

    warehouse = given.warehouse("models")
    mart = given.stored(given.mart("mart_customer_orders"))
    run = training.train_and_record(warehouse, mart, training.CUSTOMERS, RUN_AT)
    path = training.model_path(warehouse, training.CUSTOMERS, run.run_id)
    rows = training.with_features(
        training.training_rows(mart, training.CUSTOMERS), training.CUSTOMERS
    )
    loaded = RandomForestRegressionModel.load(path)
    both = loaded.setPredictionCol("loaded").transform(
        run.model.setPredictionCol("fitted").transform(rows)
    )
    return both.select(
        "customer_id",
        F.col("lifetime_value").cast("double").alias("lifetime_value"),
        (F.col("loaded") == F.col("fitted")).alias("as_fitted"),
    )


# the whole build


@check("build_all", REPORT_SQL)
def whole_build(given: Given) -> DataFrame:
    """CSV files to tested marts. The test tables have gaps on purpose, so tests fail."""
    root, seeds = given.csv_files(MARKETPLACE_FILES), given.csv_files(SEED_FILES)
    return build_all(given.warehouse("build"), root, seeds, stop_on_failure=False).report


def built(mart: str):
    """A mart as the build makes it: CSV files, loaded tables, staging, stored mart."""

    def run(given: Given) -> DataFrame:
        warehouse = given.warehouse("built")
        rows = load_csv_tables(
            warehouse, given.csv_files(MARKETPLACE_FILES), MARKETPLACE_FILES, range_bytes=REVIEW_RANGE
        )
        rows |= load_csv_tables(warehouse, given.csv_files(SEED_FILES), SEED_FILES)
        return stored_marts(warehouse, staged_views(warehouse, list(rows)))[mart]

    return run


for name in MART_NAMESPACES:
    check(f"build_all_{name}", MODEL_SQL[name])(built(name))
