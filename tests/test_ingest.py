import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from askgraph import schemas
from askgraph.functions import split_tags, strict_int
from askgraph.operators import ingest
from askgraph.sources.tables import read_raw

QUESTION = {
    "id": "1", "postTypeId": "1", "title": "t", "body": "b", "postDate": "2018", "ownerUserId": "7",
    "tags": "a|b|", "score": "-3", "acceptedAnswerId": None, "favoriteCount": None, "viewCount": "9",
}
ANSWER = {
    "id": "2", "postTypeId": "2", "body": "c", "postDate": "2019", "ownerUserId": "8", "tags": "x",
    "score": "5", "parentId": "1", "favoriteCount": "4",
}


def raw(spark, name, *rows):
    schema = schemas.RAW[name]
    return spark.createDataFrame([tuple(r.get(f) for f in schema.names) for r in rows], schema)


def fits(found, declared):
    """Same names and types, and no required column may be null."""
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in declared]
    assert not any(f.nullable and not d.nullable for f, d in zip(found, declared))


def test_posts_are_cleaned_and_aligned(spark):
    questions = raw(spark, "posts_questions", QUESTION, {**QUESTION, "id": "3", "ownerUserId": None})
    answers = raw(spark, "posts_answers", ANSWER)
    posts = ingest.clean_posts(questions, answers)
    fits(posts.schema, schemas.POSTS)
    assert [tuple(r) for r in posts.orderBy("id").collect()] == [
        ("1", 1, "t", "b", "2018", "7", ["a", "b"], -3, "", None, 0, 9),
        ("2", 2, None, "c", "2019", "8", ["x"], 5, None, "1", 4, None),
    ]


@pytest.mark.parametrize(
    "text, parts",
    [("a|b|", ["a", "b"]), ("|a", ["", "a"]), ("a||b", ["a", "", "b"]), ("||", []), ("", [""])],
)
def test_tags_split_like_the_literal_bar(spark, text, parts):
    row = spark.createDataFrame([(text,)], "tags string").select(split_tags("tags"))
    assert row.first()[0] == parts


@pytest.mark.parametrize("text, number", [("0", 0), ("+5", 5), ("-2147483648", -2147483648)])
def test_whole_numbers_parse(spark, text, number):
    assert spark.createDataFrame([(text,)], "n string").select(strict_int("n")).first()[0] == number


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["x", "", " 1", "1.0", "2147483648", None])
def test_bad_numbers_fail_the_job(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException):
            spark.createDataFrame([(text,)], "n string").select(strict_int("n")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("missing", ["id", "body", "postDate", "tags", "viewCount"])
def test_required_null_fails_the_job(spark, missing):
    questions = raw(spark, "posts_questions", {**QUESTION, missing: None})
    with pytest.raises(PySparkException):
        ingest.clean_posts(questions, raw(spark, "posts_answers", ANSWER)).collect()


def test_users_tags_comments_have_the_clean_schema(spark):
    user = dict.fromkeys(schemas.RAW_USERS.names, "1")
    tag = {"id": "1", "tagName": "c", "count": "3"}
    comment = dict.fromkeys(schemas.RAW_COMMENTS.names, "1")
    for name, clean, row in [
        ("users", ingest.clean_users, user),
        ("tags", ingest.clean_tags, tag),
        ("comments", ingest.clean_comments, comment),
    ]:
        df = clean(raw(spark, name, row))
        fits(df.schema, schemas.CLEAN[name])
        assert df.count() == 1
        with pytest.raises(PySparkException):
            clean(raw(spark, name, {**row, "id": None})).collect()


def test_json_is_read_by_name_without_inference(spark, tmp_path):
    (tmp_path / "tags.json").write_text('{"tagName":"c","id":"1"}\n{"count":"3","id":"2","x":1}\n')
    rows = read_raw(spark, str(tmp_path), "tags").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "c", None), ("2", None, "3")]
    (tmp_path / "users.json").write_text("not json\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_raw(spark, str(tmp_path), "users").select(F.col("name")).collect()
