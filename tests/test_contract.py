"""Rows that break the contract are set aside and counted; dumps of any spelling are read."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from test_ingest import ANSWER, QUESTION, raw

from askgraph import schemas
from askgraph.operators import contract, ingest
from askgraph.plans import jobs
from askgraph.session import _paths, _tables, removing_staged, staged, staged_by_key
from askgraph.sources import spellings
from askgraph.sources.tables import read_table

USER = dict.fromkeys(schemas.RAW_USERS.names, "1")


def mixed(spark):
    questions = raw(
        spark,
        "posts_questions",
        QUESTION,
        {**QUESTION, "id": "2", "score": "x"},
        {**QUESTION, "id": "3", "score": None, "body": None},
        {**QUESTION, "id": "4", "ownerUserId": None, "score": "x"},
        {**QUESTION, "id": None, "tags": None, "viewCount": "2147483648"},
    )
    answers = raw(spark, "posts_answers", ANSWER, {**ANSWER, "id": "9", "favoriteCount": " 1"})
    return {"posts_questions": questions, "posts_answers": answers}


def test_all_rules_are_counted(spark, tmp_path):
    dumps, path = mixed(spark), str(tmp_path / "posts")
    counts = contract.sort_out(dumps, path)
    assert {label: n for label, n in counts.items() if n} == {
        "rows": 6,
        "quarantined": 4,
        "id is null": 1,
        "body is null": 1,
        "tags is null": 1,
        "score is not a whole number": 2,
        "viewCount is not a whole number": 1,
        "favoriteCount is not a whole number": 1,
    }
    good = contract.accepted(spark, path, "posts")
    assert sorted(r["id"] for r in good.collect()) == ["1", "2"]
    bad = {r["id"]: r for r in contract.quarantine(spark, path, "posts").collect()}
    assert bad["3"]["broken"] == ["body is null", "score is not a whole number"]
    assert json.loads(bad["2"]["record"])["score"] == "x" and bad["2"]["score"] is None
    assert json.loads(bad["9"]["record"])["favoriteCount"] == " 1"
    assert bad[None]["broken"] == ["id is null", "tags is null", "viewCount is not a whole number"]


def test_accepted_rows_are_those_of_the_strict_cleaning(spark, tmp_path):
    clean = {
        "users": ([USER, {**USER, "id": "2", "age": ""}], ingest.clean_users),
        "tags": ([{"id": "1", "tagName": "c", "count": "3"}], ingest.clean_tags),
        "comments": ([dict.fromkeys(schemas.RAW_COMMENTS.names, "1")], ingest.clean_comments),
    }
    for name, (rows, strict) in clean.items():
        df, path = raw(spark, name, *rows), str(tmp_path / name)
        counts = contract.sort_out({name: df}, path)
        assert counts["rows"] == len(rows) and sum(counts.values()) == len(rows)
        found = contract.accepted(spark, path, name)
        assert sorted(found.collect()) == sorted(strict(df).collect())
    good = raw(spark, "posts_questions", QUESTION), raw(spark, "posts_answers", ANSWER)
    path = str(tmp_path / "posts")
    contract.sort_out(dict(zip(["posts_questions", "posts_answers"], good, strict=True)), path)
    found = contract.accepted(spark, path, "posts")
    assert sorted(found.collect()) == sorted(ingest.clean_posts(*good).collect())


def test_a_dump_is_scanned_once(spark, tmp_path):
    df = raw(spark, "tags", *({"id": str(i), "tagName": "c", "count": "3"} for i in range(50)))
    df.write.json(str(tmp_path / "tags.json"))
    read = spark.read.schema(schemas.RAW_TAGS).json(str(tmp_path / "tags.json"))
    assert contract.sort_out({"tags": read}, str(tmp_path / "t"))["rows"] == 50
    plan = contract.marked(read, "tags")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_no_rows(spark, tmp_path):
    counts = contract.sort_out({"users": raw(spark, "users")}, str(tmp_path / "u"))
    assert not any(counts.values())
    assert contract.accepted(spark, str(tmp_path / "u"), "users").count() == 0
    assert contract.quarantine(spark, str(tmp_path / "u"), "users").count() == 0


def write(folder, name, *rows):
    (folder / f"{name}.json").write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_spellings_differ_by_row(spark, tmp_path):
    write(
        tmp_path,
        "posts_answers",
        ANSWER,
        {"Id": 7, "PostTypeId": 2, "Body": "it's", "CreationDate": "2019", "OwnerUserId": 8,
         "Tags": "x", "Score": -1, "ParentId": "1", "other": {"id": 1}},
        {"id": "3", "post_type_id": "2", "postDate": None, "creation_date": "d"},
    )
    found = spellings.read_any_spelling(spark, str(tmp_path), "posts_answers")
    assert found.columns == schemas.RAW_ANSWERS.names
    rows = {r["id"]: r for r in found.collect()}
    assert rows["2"].asDict() == ANSWER
    assert (rows["7"]["body"], rows["7"]["score"], rows["7"]["postDate"]) == ("it's", "-1", "2019")
    assert (rows["3"]["postDate"], rows["3"]["postTypeId"], rows["3"]["score"]) == ("d", "2", None)
    used = {tuple(r) for r in spellings.spellings_used(spark, str(tmp_path), "posts_answers").collect()}
    assert {u for u in used if u[0] == "postDate"} == {
        ("postDate", "postDate", 1), ("postDate", "creation_date", 1), ("postDate", "CreationDate", 1),
    }
    (tmp_path / "posts_answers.json").write_text("not json\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        spellings.read_any_spelling(spark, str(tmp_path), "posts_answers").collect()


def test_a_spelling_has_one_field():
    assert spellings.spellings("tags")["tagName"] == ["tagName", "tag_name", "TagName", "tagname"]
    with pytest.raises(ValueError):
        spellings.spellings("comments", {"text": ("creation_date",)})
    with pytest.raises(ValueError):
        spellings.spellings("tags", {"nothing": ("x",)})


def dumps(folder):
    folder.mkdir()
    write(folder, "users", *({**USER, "id": u, "name": u} for u in "ABC"))
    write(folder, "tags", {"id": "1", "tag_name": "c", "count": "3"})
    write(folder, "comments", dict.fromkeys(schemas.RAW_COMMENTS.names, "1"))
    write(
        folder,
        "posts_questions",
        {**QUESTION, "ownerUserId": "A"},
        {**QUESTION, "id": "2", "ownerUserId": "B"},
        {**QUESTION, "id": "3", "ownerUserId": "C", "score": "bad"},
    )
    write(
        folder,
        "posts_answers",
        *({**ANSWER, "id": f"a{i}", "ownerUserId": u, "parentId": q} for i, (u, q) in enumerate(["B1", "A2", "C1"])),
    )
    return str(folder)


def test_job_with_quarantine_spellings_and_own_questions_left_out(spark, tmp_path):
    tables, results = str(tmp_path / "tables"), str(tmp_path / "results")
    with pytest.raises((PySparkException, Py4JJavaError)):
        jobs.run_ingest(spark, dumps(tmp_path / "dump"), str(tmp_path / "strict"), any_spelling=True)
    counts = jobs.run_ingest(spark, str(tmp_path / "dump"), tables, any_spelling=True, quarantine=True)
    assert counts["posts"]["rows"] == 6 and counts["posts"]["quarantined"] == 1
    assert counts["tags"]["quarantined"] == 0
    posts = read_table(spark, tables, "posts")
    assert posts.columns == schemas.POSTS.names
    assert posts.count() == 5
    app = spark.sparkContext.applicationId
    before = list(_paths.get(app, []))
    jobs.run_analysis(spark, tables, results, exclude_own=True)
    assert _paths[app] == before
    top = {tuple(r)[:4] for r in read_table(spark, results, "top").collect()}
    # A and B took part in both questions; C in the first only, so the second is new to C
    assert {(u, q) for u, _, q, _ in top} == {("C", "2")}
    documents = spark.read.json(f"{results}/recommendations")
    assert {r["user_id"] for r in documents.collect()} == {"A", "B", "C"}


def test_given_names_of_fields(spark, tmp_path):
    folder = dumps(tmp_path / "dump")
    write(tmp_path / "dump", "posts_questions", QUESTION)
    names = {"tags": {"tagName": "tag_name"}}
    jobs.run_ingest(spark, folder, str(tmp_path / "t"), fields=names)
    assert read_table(spark, str(tmp_path / "t"), "tags").first()["tagName"] == "c"
    with pytest.raises(ValueError):
        jobs.run_ingest(spark, folder, str(tmp_path / "t"), fields=names, any_spelling=True)


def test_staged_tables_are_removed(spark):
    kept = staged(spark, spark.range(3), "kept")
    with pytest.raises(RuntimeError), removing_staged(spark):
        gone = staged(spark, spark.range(4), "gone")
        keyed = staged_by_key(spark, spark.range(5), "keyed", "id")
        table = _tables[spark.sparkContext.applicationId][-1]
        path = gone.inputFiles()[0]
        assert keyed.count() == 5
        raise RuntimeError
    assert kept.count() == 3
    assert not spark.catalog.tableExists(table)
    with pytest.raises((PySparkException, Py4JJavaError)):
        spark.read.parquet(path).collect()
