import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from tallybook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 8)


@pytest.fixture
def many_parts(spark):
    """Keep every shuffle partition, however small, so that groups span several parts."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.unset(key)


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"
