"""Staging rules on raw tables as other tools may have typed them."""

from __future__ import annotations

from decimal import Decimal

from marketmill.checks.inputs import RAW_TABLES
from marketmill.plans.staging import MARKETPLACE_MODELS, RULES, TOY_MODELS, cleaned, raw_table_of
from marketmill.schemas import MARKETPLACE_FILES, RAW_COLUMNS, SEED_FILES
from tests.plans import plan


def test_every_raw_table_has_a_staging_table():
    tables = {raw_table_of(model) for model in RULES}
    assert tables == set(RAW_COLUMNS) == set(RAW_TABLES)
    assert tables == set(MARKETPLACE_FILES.values()) | set(SEED_FILES.values())
    assert len(TOY_MODELS) + len(MARKETPLACE_MODELS) == 11


def test_doubles_become_rounded_integers(spark):
    raw = spark.sql(
        """SELECT 'p' AS product_id, ' a ' AS product_category_name,
                  2.5D AS product_name_lenght, 3.5D AS product_description_lenght,
                  CAST(NULL AS double) AS product_photos_qty, 500D AS product_weight_g,
                  1.25D AS product_length_cm, 2D AS product_height_cm, 3D AS product_width_cm"""
    )
    row = cleaned("stg_olist_products", raw).first()
    assert tuple(row) == (
        "p", "a", 2, 4, None,
        Decimal("500.0000"), Decimal("1.2500"), Decimal("2.0000"), Decimal("3.0000"),
    )


def test_filters_go_through_staging_to_the_scan(spark, tmp_path):
    columns = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in RAW_COLUMNS["olist_order_reviews"])
    spark.sql(f"SELECT {columns}").write.parquet(str(tmp_path / "r"))
    staged = cleaned("stg_olist_order_reviews", spark.read.parquet(str(tmp_path / "r")))
    text = plan(staged.where("review_score = 5").select("order_id"))
    assert "EqualTo(review_score,5)" in text
    assert "ReadSchema: struct<order_id:string,review_score:int>" in text
