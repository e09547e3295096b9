import json
from unittest import mock

import pytest
from pyspark.errors import PySparkException

from askgraph.plans import jobs
from askgraph.session import shared_folder, staged
from askgraph.sources import tables


def test_parquet_is_replaced(spark, tmp_path):
    for n in (3, 2):
        tables.write_table(spark.range(n), str(tmp_path), "t")
    assert tables.read_table(spark, str(tmp_path), "t").count() == 2


def test_documents_do_not_replace_by_default(spark, tmp_path):
    path = str(tmp_path / "d")
    df = spark.createDataFrame([("A", ["x"])], "_id string, posts array<string>")
    tables.write_documents(df, "json", path=path)
    assert spark.read.schema(df.schema).json(path).collect() == df.collect()
    with pytest.raises(PySparkException):
        tables.write_documents(df, "json", path=path)


def test_jdbc_arguments():
    """No database here: only what is handed to the writer is checked."""
    df = mock.MagicMock()
    tables.write_jdbc(df, "jdbc:postgresql://h:1/d", "users", "me", "secret", batchsize="500")
    df.write.mode.assert_called_once_with("append")
    df.write.mode.return_value.jdbc.assert_called_once_with(
        "jdbc:postgresql://h:1/d",
        "users",
        properties={
            "user": "me", "password": "secret", "driver": "org.postgresql.Driver", "batchsize": "500",
        },
    )


def test_staged_table_is_read_back(spark):
    df = staged(spark, spark.range(5), "five")
    assert df.count() == 5
    assert "parquet" in df._jdf.queryExecution().executedPlan().toString().lower()


def test_local_folder_is_refused_on_a_cluster():
    session = mock.MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getConf.return_value.get.return_value = None
    session.sparkContext.applicationId = "app-on-a-cluster"
    session.sparkContext.master = "yarn"
    with pytest.raises(ValueError):
        shared_folder(session)


def test_folder_of_the_session_is_used():
    session = mock.MagicMock()
    session.conf.get.return_value = "hdfs:///shared/"
    assert shared_folder(session) == "hdfs:///shared"


def test_jobs_end_to_end(spark, tmp_path):
    questions = [
        {"id": "q1", "ownerUserId": "A", "acceptedAnswerId": "a1"},
        {"id": "q2", "ownerUserId": "B"},
        {"id": "q4"},
    ]
    answers = [("a1", "B", "q1"), ("a2", "C", "q1"), ("a3", "A", "q2")]
    dumps = {
        "posts_questions": [
            {"postTypeId": "1", "title": q["id"], "body": "b", "postDate": "d", "tags": "t|",
             "score": "1", "viewCount": "2", **q}
            for q in questions
        ],
        "posts_answers": [
            {"id": i, "postTypeId": "2", "body": "b", "postDate": "d", "ownerUserId": u, "tags": "t",
             "score": "1", "parentId": p}
            for i, u, p in answers
        ],
        "users": [
            {"id": u, "name": u, "age": "", "creationDate": "", "location": "", "reputation": "1",
             "upVotes": "1", "downVotes": "1", "views": "1"}
            for u in "ABC"
        ],
        "tags": [{"id": "1", "tagName": "t", "count": "2"}],
        "comments": [{"id": "1", "text": "x", "creationDate": "", "postId": "q1", "userId": "A"}],
    }
    for name, rows in dumps.items():
        (tmp_path / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))
    clean, results = str(tmp_path / "clean"), str(tmp_path / "results")
    jobs.run_ingest(spark, str(tmp_path), clean)
    assert tables.read_table(spark, clean, "posts").count() == 5
    jobs.run_analysis(spark, clean, results)

    stored = spark.read.json(f"{results}/recommendations").collect()
    lists = {r["user_id"]: [(p["question_id"], p["neighbor_id"], p["weight"]) for p in r["posts"]] for r in stored}
    assert lists == {"A": [("q2", "B", 13)], "B": [("q2", "A", 13)], "C": [("q2", "A", 6), ("q2", "B", 5)]}
    texts = {r["user_id"]: json.loads(r["feed"]) for r in tables.read_table(spark, results, "feeds").collect()}
    assert texts["C"]["1"]["connection"] == "B" and texts["C"]["user"]["name"] == "C"
