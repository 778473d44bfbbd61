"""The whole build on small files with known results."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from marketmill.operators.governance import ANALYST, ENGINEER, with_row_policy
from marketmill.operators.quality import QualityError, assert_all_pass
from marketmill.plans import build
from marketmill.plans.build import build_all
from marketmill.plans.quality_suite import suite
from marketmill.plans.roles import all_tables, register_role_views, role_view
from marketmill.sources.tables import Warehouse
from tests import rows
from tests.conftest import write_files


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("built")
    landing = write_files(folder / "landing", rows.MARKETPLACE)
    seeds = write_files(folder / "seeds", rows.SEEDS)
    return Warehouse(spark, str(folder / "warehouse"), prefix="built_"), landing, seeds


@pytest.fixture(scope="module")
def built(place):
    return build_all(*place)


def as_dict(df, key):
    return {row[key]: tuple(row)[1:] for row in df.collect()}


def test_row_counts(built):
    assert built.rows == {
        "olist_customers": 5,
        "olist_orders": 5,
        "olist_order_items": 5,
        "olist_order_payments": 5,
        "olist_order_reviews": 5,
        "olist_products": 3,
        "olist_sellers": 2,
        "olist_geolocation": 7,
        "olist_product_category_translation": 3,
        "raw_customers": 10,
        "raw_orders": 15,
    }


def test_all_data_tests_pass(built):
    report = built.report.collect()
    assert len(report) == len(suite()) == 73
    assert all(row["failures"] == 0 for row in report)


def test_customer_mart(built):
    mart = built.models["mart_customer_orders"].select(
        "customer_id",
        "total_orders",
        "lifetime_value",
        "avg_order_value",
        "first_order_date",
        "last_order_date",
        "completed_orders",
        "cancelled_orders",
    )
    d, day = Decimal, date.fromisoformat
    assert as_dict(mart, "customer_id") == {
        1: (2, d("210.49"), 105.245, day("2024-02-10"), day("2024-03-15"), 2, 0),
        2: (2, d("390.00"), 195.0, day("2024-02-20"), day("2024-06-05"), 2, 0),
        3: (2, d("355.75"), 177.875, day("2024-03-05"), day("2024-04-01"), 1, 0),
        4: (2, d("148.00"), 74.0, day("2024-03-20"), day("2024-06-10"), 1, 1),
        5: (1, d("180.00"), 180.0, day("2024-04-10"), day("2024-04-10"), 1, 0),
        6: (1, d("95.25"), 95.25, day("2024-04-18"), day("2024-04-18"), 0, 0),
        7: (2, d("507.50"), 253.75, day("2024-05-02"), day("2024-05-15"), 2, 0),
        8: (1, d("200.00"), 200.0, day("2024-05-20"), day("2024-05-20"), 0, 0),
        9: (1, d("55.00"), 55.0, day("2024-05-25"), day("2024-05-25"), 1, 0),
        10: (1, d("320.00"), 320.0, day("2024-06-01"), day("2024-06-01"), 0, 0),
    }


def test_marketplace_customer_mart(built):
    d, at = Decimal, datetime.fromisoformat
    mart = built.models["mart_olist_customer_orders"]
    assert as_dict(mart, "customer_unique_id") == {
        "cust_unique_1": (
            2, d("385.00"), 192.5, at("2024-01-05T10:00"), at("2024-02-01T12:00"), 2, 0,
        ),
        "cust_unique_2": (
            1, d("90.00"), 90.0, at("2024-01-08T09:30"), at("2024-01-08T09:30"), 1, 0,
        ),
        "cust_unique_3": (
            1, d("58.00"), 58.0, at("2024-02-10T15:00"), at("2024-02-10T15:00"), 0, 0,
        ),
        "cust_unique_4": (
            1, d("69.00"), 69.0, at("2024-02-15T08:00"), at("2024-02-15T08:00"), 0, 1,
        ),
    }


def test_seller_mart(built):
    mart = built.models["mart_olist_seller_performance"]
    assert as_dict(mart, "seller_id") == {
        "seller_1": ("sao paulo", "SP", 3, Decimal("410.00"), Decimal("44.00"), 11 / 3, 3),
        "seller_2": ("sao paulo", "SP", 2, Decimal("130.00"), Decimal("18.00"), 3.5, 2),
    }


def test_one_location_per_prefix(built):
    places = as_dict(built.models["stg_olist_geolocation"], "geolocation_zip_code_prefix")
    assert len(places) == 6
    assert places["01001"] == (-23.5505, -46.6335, "sao paulo", "SP")


def test_role_views(built, place):
    warehouse = place[0]
    mart = built.models["mart_customer_orders"]

    assert role_view(warehouse, ENGINEER, "marts", "mart_customer_orders").count() == 10
    with pytest.raises(PermissionError):
        role_view(warehouse, ANALYST, "marts", "mart_customer_orders")
    seen = role_view(warehouse, ANALYST, "marts", "mart_customer_orders_masked")
    emails = {row["customer_id"]: row["email"] for row in seen.collect()}
    assert len(emails) == 10
    assert emails[1] == "a****@example.com"

    allowed = with_row_policy(mart, ANALYST, "mart_customer_orders")
    assert sorted(row["customer_id"] for row in allowed.collect()) == [1, 2, 3, 4, 5, 7, 9]
    assert role_view(warehouse, ANALYST, "olist_marts", "mart_olist_customer_orders").count() == 2
    assert with_row_policy(mart, "visitor", "mart_customer_orders").count() == 0
    assert role_view(warehouse, ANALYST, "olist_marts", "mart_olist_seller_performance").count() == 2
    for layer, table in (("raw", "raw_customers"), ("staging", "stg_customers")):
        with pytest.raises(PermissionError):
            role_view(warehouse, ANALYST, layer, table)
        role_view(warehouse, ENGINEER, layer, table)
    with pytest.raises(PermissionError):
        role_view(warehouse, "visitor", "marts", "mart_customer_orders_masked")
    with pytest.raises(AttributeError):  # a frame of one's own cannot be handed in
        role_view(mart, ANALYST, "marts", "mart_customer_orders_masked")
    assert register_role_views(warehouse, ANALYST) == [
        "built_analyst_olist_marts_mart_olist_customer_orders",
        "built_analyst_olist_marts_mart_olist_seller_performance",
        "built_analyst_marts_mart_customer_orders_masked",
    ]
    assert len(register_role_views(warehouse, ENGINEER)) == len(all_tables()) == 26
    assert warehouse.spark.table("built_engineer_staging_stg_customers").count() == 10


def test_failing_data_stops_the_build(warehouse, tmp_path):
    texts = dict(rows.MARKETPLACE)
    texts["olist_order_payments_dataset.csv"] += "order_9,1,barter,1,-5.00\n"
    landing = write_files(tmp_path / "landing", texts)
    seeds = write_files(tmp_path / "seeds", rows.SEEDS)
    with pytest.raises(QualityError) as failed:
        build_all(warehouse, landing, seeds)
    lines = str(failed.value).splitlines()
    assert lines[0] == "3 data tests failed:"
    assert lines[1:] == [
        "stg_olist_order_payments.order_id relationships: 1",
        "stg_olist_order_payments.payment_type accepted_values: 1",
        "stg_olist_order_payments.payment_value expression_is_true: 1",
    ]


def test_rebuild_gives_the_same_marts(place, built):
    before = sorted(map(tuple, built.models["mart_olist_customer_orders"].collect()))
    second = build_all(*place)
    assert second.rows == built.rows
    after = sorted(map(tuple, second.models["mart_olist_customer_orders"].collect()))
    assert after == before
    assert_all_pass(second.report)


def test_shared_folder_is_the_configured_one(spark):
    from marketmill.session import scratch_path, shared_folder

    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def counted_stages(monkeypatch):
    made, stage = [], Warehouse.stage

    def counted(self, df, namespace, table):
        written = stage(self, df, namespace, table)
        made.append(f"{namespace}.{table}")
        return written

    monkeypatch.setattr(Warehouse, "stage", counted)

    def since() -> list[str]:
        names = [name for name in made if not name.startswith("build.")]
        made.clear()
        return names

    return since


def test_a_broken_build_goes_on_where_it_stopped(spark, warehouse, marketplace_files, tmp_path, monkeypatch):
    seeds = write_files(tmp_path / "seeds", rows.SEEDS)
    stages = counted_stages(monkeypatch)
    whole = build.all_marts

    def broken(staged):
        marts = whole(staged)
        bad = F.raise_error(F.lit("broken mart"))
        name = "mart_olist_seller_performance"
        return marts | {name: marts[name].withColumn("seller_id", bad.cast("string"))}

    monkeypatch.setattr(build, "all_marts", broken)
    with pytest.raises(Exception, match="broken mart"):
        build.build_all(warehouse, marketplace_files, seeds, resume=True)
    assert len(stages()) == 13 and not warehouse.exists("marts", "mart_customer_orders")
    monkeypatch.setattr(build, "all_marts", whole)
    done = build.build_all(warehouse, marketplace_files, seeds, stop_on_failure=False, resume=True)
    assert stages() == ["olist_marts.mart_olist_seller_performance"]
    plain = {name: sorted(map(str, df.collect())) for name, df in done.models.items()}
    again = build.build_all(warehouse, marketplace_files, seeds, stop_on_failure=False, resume=True)
    assert stages() == [] and again.rows == done.rows
    fresh = build.build_all(warehouse, marketplace_files, seeds, stop_on_failure=False)
    assert {name: sorted(map(str, df.collect())) for name, df in fresh.models.items()} == plain


def test_a_changed_file_is_loaded_again(spark, warehouse, marketplace_files, tmp_path, monkeypatch):
    seeds = write_files(tmp_path / "seeds", rows.SEEDS)
    build.build_all(warehouse, marketplace_files, seeds, stop_on_failure=False, resume=True)
    stages = counted_stages(monkeypatch)
    write_files(tmp_path / "landing", {"olist_sellers_dataset.csv": rows.MARKETPLACE["olist_sellers_dataset.csv"] + "new_seller,01001,x,SP\n"})
    done = build.build_all(warehouse, marketplace_files, seeds, stop_on_failure=False, resume=True)
    made = stages()
    assert made[0] == "raw.olist_sellers" and len(made) == 4
    assert done.models["stg_olist_sellers"].where("seller_id = 'new_seller'").count() == 1
