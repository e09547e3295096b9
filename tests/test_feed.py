import hashlib
import json

import pytest
from pyspark.sql import functions as F

from askgraph import schemas
from askgraph.operators import feed as feeds
from askgraph.operators import reports

TOP = "user_id string, rank int, question_id string, neighbor_id string, weight bigint"


@pytest.fixture(scope="module")
def tables(spark):
    posts = spark.createDataFrame(
        [
            ("q1", 1, 'a "title"', "body", "2018", "B", ["x"], 3, "", None, 0, 9),
            ("q2", 1, "other", "text", "2019", "C", ["x"], 4, "", None, 1, 8),
            ("a1", 2, None, "answer", "2019", "A", ["x"], 5, None, "q1", 2, None),
        ],
        schemas.POSTS,
    )
    users = spark.createDataFrame(
        [("A", "Ann", "", "", "Here", 1, 2, 3, 4), ("B", "Bo", "", "", "There", 5, 6, 7, 8)],
        schemas.USERS,
    )
    top = spark.createDataFrame(
        [("A", 1, "q1", "B", 9), ("A", 2, "gone", "C", 7), ("Z", 1, "q2", "A", 5)], TOP
    )
    return top, posts, users


def test_feed_joins_details_and_keeps_what_exists(tables):
    rows = {(r["user_id"], r["rank"]): r for r in feeds.feed(*tables).collect()}
    assert set(rows) == {("A", 1), ("A", 2), ("Z", 1)}
    one = rows["A", 1]
    assert (one["post_title"], one["post_view_count"], one["post_connection"]) == ('a "title"', 9, "B")
    assert (one["user_name"], one["user_downVotes"], one["weight"]) == ("Ann", 3, 9)
    assert rows["A", 2]["post_id"] == "gone" and rows["A", 2]["post_title"] is None
    assert rows["Z", 1]["user_name"] is None and rows["Z", 1]["post_title"] == "other"


def test_feed_json(spark, tables):
    listed = spark.createDataFrame([("A",), ("B",), ("Z",)], "user_id string")
    texts = {r[0]: json.loads(r[1]) for r in feeds.feed_json(feeds.feed(*tables, listed)).collect()}
    assert list(texts["A"]) == ["0", "1", "user"]
    assert list(texts["A"]["0"]) == [
        "id", "title", "body", "post_date", "owner_user_id", "score", "favorite_count",
        "view_count", "connection",
    ]
    assert texts["A"]["0"]["title"] == 'a "title"'
    assert texts["A"]["1"]["title"] is None
    assert list(texts["B"]) == ["user"]
    assert texts["B"]["user"] == {
        "id": "B", "name": "Bo", "location": "There", "reputation": 5, "upVotes": 6,
        "downVotes": 7, "views": 8,
    }
    assert texts["Z"]["user"]["id"] == "Z" and texts["Z"]["user"]["name"] is None


def test_answer_participation(spark, make_posts):
    users = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "id string")
    posts = make_posts(
        [(f"a{i}", 2, "A", "q", None) for i in range(6)]
        + [(f"b{i}", 2, "B", "q", None) for i in range(5)]
        + [(f"c{i}", 1, "C", None, "") for i in range(9)]
    )
    assert tuple(reports.answer_participation(users, posts).first()) == (4, 1, 0.25)


def test_samples_and_peek(spark):
    ids = spark.range(4000).selectExpr("cast(id as string) as id")
    once, again = (reports.sample_by_id(ids, 0.1).orderBy("id").collect() for _ in range(2))
    assert once == again and 300 < len(once) < 500
    assert 300 < reports.sample_rows(ids).count() < 500
    assert reports.sample_by_id(ids, 1.0).count() == 4000
    assert [r[0] for r in reports.peek(ids, "id", n=3).collect()] == ["0", "1", "10"]
    assert reports.peek(ids).count() == 20


@pytest.mark.parametrize("fraction", [0.0004, 0.0015, 0.9996])
def test_fine_fractions_are_kept_exactly(spark, fraction):
    ids = spark.range(100_000).select(F.col("id").cast("string"))

    def number(i):
        return int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16)

    expected = sum(number(i) < round(fraction * 2**32) for i in range(100_000))
    assert 0 < expected < 100_000
    assert reports.sample_by_id(ids, fraction).count() == expected


def test_fractions_beyond_the_range_are_refused(spark):
    with pytest.raises(ValueError):
        reports.sample_by_id(spark.range(3).select(F.col("id").cast("string")), 1.5)
