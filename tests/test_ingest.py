"""Landing files."""

from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from marketmill.checks import jobs  # noqa: F401
from marketmill.checks.registry import CHECKS
from marketmill.schemas import MARKETPLACE_FILES, RAW_COLUMNS, SEED_FILES
from marketmill.sources.csv_files import (
    load_csv_tables,
    missing_files,
    read_csv_table,
    remote_root,
    require_files,
    source_root,
    write_csv_table,
)
from tests import rows
from tests.conftest import write_files


def one_file(tmp_path, name, text):
    return f"{write_files(tmp_path / 'one', {name: text})}/{name}"


def test_zip_prefixes_keep_their_zeros(warehouse, marketplace_files):
    load_csv_tables(warehouse, marketplace_files, MARKETPLACE_FILES)
    zips = {
        row[0]
        for row in warehouse.read("raw", "olist_customers")
        .select("customer_zip_code_prefix")
        .collect()
    }
    assert zips == {"01001", "20040", "30140", "40010"}


def test_reload_gives_the_same_rows(warehouse, marketplace_files):
    first = load_csv_tables(warehouse, marketplace_files, MARKETPLACE_FILES)
    second = load_csv_tables(warehouse, marketplace_files, MARKETPLACE_FILES)
    assert first == second
    for table, count in second.items():
        assert warehouse.read("raw", table).count() == count


def test_all_missing_files_are_named_and_nothing_is_written(spark, warehouse, tmp_path):
    texts = dict(rows.MARKETPLACE)
    del texts["olist_orders_dataset.csv"], texts["olist_sellers_dataset.csv"]
    landing = write_files(tmp_path / "landing", texts)
    with pytest.raises(FileNotFoundError) as failed:
        load_csv_tables(warehouse, landing, MARKETPLACE_FILES)
    assert "olist_orders_dataset.csv, olist_sellers_dataset.csv" in str(failed.value)
    assert not (tmp_path / "warehouse").exists()
    assert missing_files(spark, landing, SEED_FILES) == list(SEED_FILES)


def test_failed_load_keeps_the_previous_one(warehouse, marketplace_files, tmp_path):
    load_csv_tables(warehouse, marketplace_files, MARKETPLACE_FILES)
    texts = dict(rows.MARKETPLACE)
    texts["olist_order_items_dataset.csv"] += "order_6,one,p,s,2024-01-06 00:00:00,1.00,1.00\n"
    texts["olist_customers_dataset.csv"] += "cust_id_6,cust_unique_5,01001,x,SP\n"
    broken = write_files(tmp_path / "broken", texts)
    with pytest.raises(PySparkException):
        load_csv_tables(warehouse, broken, MARKETPLACE_FILES)
    assert warehouse.read("raw", "olist_customers").count() == 5
    assert warehouse.read("raw", "olist_order_items").count() == 5


def test_missing_value_tokens(spark, tmp_path):
    path = one_file(
        tmp_path,
        "p.csv",
        "product_id,product_category_name,product_name_lenght,product_description_lenght,"
        "product_photos_qty,product_weight_g,product_length_cm,product_height_cm,"
        "product_width_cm\n"
        "a,NA,45.0,,null,NaN,1.5,#N/A,2\n"
        'b,"nan",2.5,3.5,"",None,<NA>,n/a,-NaN\n'
        "c,N A,38,150,1,300,15,8,12\n",
    )
    found = {row["product_id"]: tuple(row)[1:] for row in read_csv_table(
        spark, path, "olist_products").collect()}
    assert found["a"][:4] == (None, 45, None, None)
    assert found["a"][4] is None and float(found["a"][5]) == 1.5 and found["a"][6] is None
    assert found["b"] == (None, 2, 4, None, None, None, None, None)
    assert found["c"][0] == "N A"


def test_line_breaks_and_quotes_in_reviews(spark, tmp_path):
    head = rows.MARKETPLACE["olist_order_reviews_dataset.csv"].splitlines()[0]
    path = one_file(
        tmp_path,
        "r.csv",
        head + '\nr1,o1,5,"so, ""good""","line one\n\nline, three",2024-01-11 00:00:00,\n'
        "r2,o2,4,,,2024-01-11 00:00:00,2024-01-12 00:00:00\n",
    )
    found = read_csv_table(spark, path, "olist_order_reviews").orderBy("review_id").collect()
    assert found[0]["review_comment_title"] == 'so, "good"'
    assert found[0]["review_comment_message"] == "line one\n\nline, three"
    assert found[0]["review_answer_timestamp"] is None
    assert found[1]["review_comment_title"] is None


@pytest.mark.parametrize("multi_line", [False, True])
def test_byte_order_mark_and_windows_line_ends(spark, tmp_path, multi_line):
    text = "\ufeffproduct_category_name,product_category_name_english\r\na,b\r\nc,\r\n"
    path = tmp_path / "t.csv"
    path.write_bytes(text.encode("utf-8"))
    found = read_csv_table(
        spark, str(path), "olist_product_category_translation", multi_line=multi_line
    )
    assert sorted(map(tuple, found.collect()), key=str) == [("a", "b"), ("c", None)]


def test_folder_of_parts_is_one_table(spark, tmp_path):
    head, *lines = rows.MARKETPLACE["olist_orders_dataset.csv"].splitlines()
    parts = {f"part-{i}.csv": f"{head}\n{line}\n" for i, line in enumerate(lines)}
    write_files(tmp_path / "landing" / "olist_orders_dataset.csv", parts)
    found = read_csv_table(
        spark, str(tmp_path / "landing" / "olist_orders_dataset.csv"), "olist_orders"
    )
    assert found.count() == 5 and found.where("order_approved_at IS NULL").count() == 1


@pytest.mark.parametrize(
    "text",
    [
        "seller_id,seller_city,seller_zip_code_prefix,seller_state\ns,x,1,SP\n",
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,1\n",
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,1,x,SP,extra\n",
    ],
)
def test_wrong_layout_fails(spark, tmp_path, text):
    with pytest.raises(Exception, match="header does not conform|MALFORMED"):
        read_csv_table(spark, one_file(tmp_path, "s.csv", text), "olist_sellers").collect()


def test_wrong_value_fails(spark, tmp_path):
    path = one_file(
        tmp_path, "o.csv", "order_id,customer_id,order_date,status,amount\n1,2,someday,x,5\n"
    )
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        read_csv_table(spark, path, "raw_orders").collect()


def test_csv_round_trip_keeps_spaces_and_breaks(spark, tmp_path):
    head = ", ".join(f"{name} string" for name, _ in RAW_COLUMNS["olist_sellers"])
    df = spark.createDataFrame([(" a ", "01", 'x "y", z', None)], head)
    write_csv_table(df, str(tmp_path / "s.csv"))
    back = read_csv_table(spark, str(tmp_path / "s.csv"), "olist_sellers")
    assert tuple(back.first()) == (" a ", "01", 'x "y", z', None)


def test_compressed_parts_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("marketmill.sources.csv_files.PART_ROWS", 40)
    head = ", ".join(f"'v' || id % {n} AS {name}" for n, (name, _) in enumerate(RAW_COLUMNS["olist_sellers"], 2))
    df = spark.range(0, 100, 1, 1).selectExpr(*head.split(", "))
    folder = tmp_path / "s.csv"
    write_csv_table(df, str(folder), compressed=True)
    assert len(list(folder.glob("part-*.csv.gz"))) == 3
    back = read_csv_table(spark, str(folder), "olist_sellers")
    assert back.count() == 100 and back.exceptAll(df).count() == 0


def test_remote_copy_only_when_needed(spark, tmp_path, marketplace_files):
    empty = str(tmp_path / "empty")
    assert source_root(spark, marketplace_files, MARKETPLACE_FILES, "bucket") == marketplace_files
    assert source_root(spark, empty, MARKETPLACE_FILES, None) == empty
    assert (
        source_root(spark, empty, MARKETPLACE_FILES, "bucket") == "s3a://bucket/olist-raw/"
    )
    assert remote_root("gs://other/") == "gs://other/olist-raw/"


def test_files_in_the_remote_folder_are_read_in_place(spark, warehouse, tmp_path):
    write_files(tmp_path / "bucket" / "olist-raw", rows.MARKETPLACE)
    root = source_root(
        spark, str(tmp_path / "empty"), MARKETPLACE_FILES, str(tmp_path / "bucket")
    )
    require_files(spark, root, MARKETPLACE_FILES)
    assert load_csv_tables(warehouse, root, MARKETPLACE_FILES)["olist_geolocation"] == 7


def test_the_remote_copy_may_have_many_parts(spark, tmp_path):
    """Parts keep their header when there are several, and when several lie in one split."""
    parts = spark.range(40).select(
        F.col("id").alias("p_partkey"),
        F.concat(F.lit("part "), "id").alias("p_name"),
        F.concat(F.lit("type "), F.col("id") % 3).alias("p_type"),
        (F.col("id") % 50).cast("int").alias("p_size"),
        (F.col("id") + 0.5).alias("p_retailprice"),
    )
    parts.repartition(12).write.parquet(str(tmp_path / "part.parquet"))
    found = CHECKS["csv_remote_source"].query(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect())) == sorted((str(i), i % 50) for i in range(40))
