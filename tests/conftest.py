from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from stayrate.session import local_session  # noqa: E402

DATA = Path("/root/testdata")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "stayrate-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_dir():
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return str(DATA / "sf0.01")


@pytest.fixture(scope="session")
def customers(spark, sf_dir):
    from stayrate.sources.derived import derive_customers

    return derive_customers(spark, sf_dir).cache()


@pytest.fixture(scope="session")
def scores(spark, sf_dir):
    from stayrate.sources.derived import derive_scores

    return derive_scores(spark, sf_dir).cache()
