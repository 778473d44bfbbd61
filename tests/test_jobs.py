"""The jobs from the command line."""

from __future__ import annotations

import json

import pytest

from marketmill.__main__ import main, parse
from tests import rows
from tests.conftest import write_files


def test_all_jobs(spark, tmp_path, capsys):
    landing = write_files(tmp_path / "landing", rows.MARKETPLACE)
    seeds = write_files(tmp_path / "seeds", rows.SEEDS)
    nodes = {
        name: {"resource_type": "model", "name": name, "description": text, "columns": {}}
        for name, text in (("customers", "all customers"), ("orders", "all orders"))
    }
    nodes["orders"]["columns"] = {"amount": {"description": "what was paid"}}
    manifests = write_files(tmp_path / "m", {"manifest.json": json.dumps({"nodes": nodes})})
    reports = main(
        ["build", "train", "index", "ask", "--warehouse", str(tmp_path / "w"), "--prefix", "cli_"]
        + ["--landing", landing, "--seeds", seeds, "--manifests", manifests]
        + ["--question", "all orders", "--hits", "1", "--master", "local[8]"]
    )
    assert reports["build"]["raw_orders"] == 15
    assert reports["train"]["lifetime_value_prediction"]["test_rows"] == 2
    assert reports["train"]["olist_lifetime_value_prediction"]["test_rows"] == 1
    assert reports["index"] == {"stored": 3, "skipped": 0}
    assert reports["ask"] == "- [model] orders: all orders"
    assert spark.table("cli_ml.ml_runs").count() == 2
    assert "ask: - [model] orders: all orders" in capsys.readouterr().out


def test_missing_options_are_named(capsys):
    with pytest.raises(SystemExit):
        parse(["build", "--warehouse", "w", "--landing", "l"])
    assert "build needs --seeds" in capsys.readouterr().err
