from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from bazaarlake.plans.warehouse import Warehouse  # noqa: E402
from bazaarlake.session import build_session  # noqa: E402
from bazaarlake.sources.schemas import BRONZE  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "5000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def set_(**settings):
        for key, value in settings.items():
            name = "spark.sql." + key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="session")
def sf_small():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("test data not present")
    return str(path)


def ts(text: str | None) -> datetime | None:
    return datetime.fromisoformat(text) if text else None


@pytest.fixture
def tiny(spark):
    """A warehouse over hand-made raw rows; tables not given are empty."""

    def build(params=None, **rows):
        def raw(name):
            return spark.createDataFrame(rows.get(name, []), BRONZE[name])

        return Warehouse(spark, raw, params) if params else Warehouse(spark, raw)

    return build
