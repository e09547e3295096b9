import pytest

from askgraph.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    """Workers find the library wherever the tests are started."""
    ship(spark)
