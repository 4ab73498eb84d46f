import pytest

from sparkloom.llm.common import reach_workers


@pytest.fixture(scope="session", autouse=True)
def _workers(spark):
    reach_workers(spark)
