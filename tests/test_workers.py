"""Jobs run where the package is not installed."""

from __future__ import annotations

import os
import subprocess
import sys

from tests.conftest import ROOT

SCRIPT = """
import os, sys
sys.path.insert(0, {root!r})
from marketmill.session import build_session
from marketmill.operators.embed import embedded
from marketmill.operators.nearest import nearest, nearest_for_each
from pyspark.sql import functions as F

spark = build_session(master="local[2]", spark__checkpoint__dir={folder!r})
spark.sparkContext.setLogLevel("OFF")
rows = spark.range(20).selectExpr("id", "array(CAST(id AS float), 1f) AS embedding",
                                  "concat('t', id) AS description")
asked = spark.range(2).selectExpr("id AS question_id", "array(1f, 1f) AS embedding")
print("found", nearest(rows, [1.0, 1.0], 3).first()["id"],
      nearest_for_each(rows, asked, 3).count(),
      embedded(rows.drop("embedding"), lambda texts: [[1.0]] * len(texts)).count())
"""


def test_worker_functions_do_not_import_the_package(tmp_path):
    """A driver elsewhere: its Python workers cannot import the package by name."""
    script = tmp_path / "job.py"
    script.write_text(SCRIPT.format(root=ROOT, folder=str(tmp_path / "shared")))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, str(script)],
        cwd=tmp_path,
        env=environment,
        capture_output=True,
        text=True,
        timeout=240,
        check=False,
    )
    assert "found 1 6 20" in done.stdout, done.stderr[-2000:]
