import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from askgraph.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "askgraph-tests",
        master="local[8]",
        shuffle_partitions=4,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


POST_COLUMNS = "id string, postTypeId int, ownerUserId string, parentId string, acceptedAnswerId string"


@pytest.fixture(scope="session")
def make_posts(spark):
    def build(rows):
        return spark.createDataFrame(rows, POST_COLUMNS)

    return build


@pytest.fixture(scope="session")
def case(make_posts):
    """The hand-worked case: eleven posts, one without an owner (dropped here)."""
    rows = [
        ("q1", 1, "A", None, "a1"),
        ("q2", 1, "B", None, ""),
        ("q3", 1, "C", None, ""),
        ("q4", 1, None, None, ""),
        ("a1", 2, "B", "q1", None),
        ("a2", 2, "C", "q1", None),
        ("a3", 2, "A", "q2", None),
        ("a4", 2, "C", "q2", None),
        ("a5", 2, "C", "q2", None),
        ("a6", 2, "C", "q3", None),
        ("a7", 2, "D", "q1", None),
    ]
    return make_posts(rows).where("ownerUserId is not null")
