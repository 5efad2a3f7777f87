import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from keystrata.session import local_session  # noqa: E402
from keystrata.sources.tables import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        "tests",
        **{
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, f"t{uuid.uuid4().hex[:10]}", str(tmp_path / "lake"))


@pytest.fixture(scope="session")
def plan_of():
    return lambda df: df._jdf.queryExecution().executedPlan().toString()
