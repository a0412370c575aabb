from __future__ import annotations

import itertools
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mentionlake.plans.layout import Lake, create_tables  # noqa: E402
from mentionlake.session import get_spark  # noqa: E402

_numbers = itertools.count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark("tests", **{
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    n = next(_numbers)
    made = Lake(str(tmp_path / "lake"), f"bronze{n}", f"silver{n}", f"mart{n}", f"ops{n}", "test")
    create_tables(spark, made)
    return made


@pytest.fixture
def rows():
    """Rows of a DataFrame as a sorted list of tuples."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

    return collect
