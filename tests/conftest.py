from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from marketmill.session import build_session  # noqa: E402
from marketmill.sources.tables import Warehouse  # noqa: E402
from tests import rows  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests",
        master="local[8]",
        spark__driver__memory="6g",
        spark__checkpoint__dir=folder,
        spark__sql__warehouse__dir=f"{folder}/default",
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def warehouse(spark, tmp_path):
    prefix = tmp_path.name.replace("-", "_") + "_"
    return Warehouse(spark, str(tmp_path / "warehouse"), prefix=prefix)


def write_files(folder, texts):
    folder.mkdir(parents=True, exist_ok=True)
    for name, text in texts.items():
        (folder / name).write_text(text, encoding="utf-8")
    return str(folder)


@pytest.fixture
def marketplace_files(tmp_path):
    return write_files(tmp_path / "landing", rows.MARKETPLACE)
