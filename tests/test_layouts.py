"""Stored layouts: co-partitioned links and bags, documents by user, maps merged in a tree."""

import re

import pytest
from pyspark.sql import functions as F

from askgraph.operators import feed as feeds
from askgraph.operators import network, recommend
from askgraph.session import new_path, staged_by_key
from askgraph.sources import corpus
from test_network import crowd
from test_recommend import busy, prepare, tops


def test_stored_links_and_bags_join_without_exchange(spark, make_posts):
    _, _, links, bags = prepare(make_posts(busy(31)))
    expected = sorted(map(tuple, recommend.candidates(links, bags).collect()))
    links, bags = (staged_by_key(spark, t, "side", "neighbor_id", 4) for t in (links, bags))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = recommend.candidates(links, bags)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        found = sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert found == expected


def test_request_opens_its_own_files_only(spark, make_posts):
    weights, accepted, links, bags = prepare(make_posts(busy(32, users=60, questions=30, answers=300)))
    path = new_path(spark, "documents")
    feeds.write_keyed_documents(recommend.recommendations(links, bags, page=10), path, buckets=40)
    asked = spark.createDataFrame([("u1",), ("u2",), ("u1",), ("nobody",)], "user_id string")
    found = feeds.requested_documents(spark, path, asked)
    assert tops(found) == tops(recommend.top_candidates(weights, accepted, requests=asked))
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[(.*?)\], ", plan)[1]
    assert re.search(r"head#\d+ = 1", filters) and 1 <= len(re.search(r"bucket#\d+ IN \(([\d,]+)\)", filters)[1].split(",")) <= 3
    assert re.search(r"ReadSchema: struct<user_id:string,top:", plan)
    assert "posts" not in re.search(r"ReadSchema: .*", plan)[0]
    everybody = weights.select("user_id").distinct()
    assert tops(feeds.requested_documents(spark, path, everybody)) == tops(recommend.top_candidates(weights, accepted))


@pytest.mark.parametrize(("chunk", "fan"), [(3, 2), (7, 3), (100_000, 64)])
def test_maps_of_posts_merge_to_the_maps_of_sums(make_posts, chunk, fan):
    df = make_posts(crowd(size=25) + [(f"again{i}", 2, "u1", "q0", None) for i in range(30)])
    accepted = network.accepted_answers(df)
    summed = network.question_weight_maps(network.question_user_weights(df, accepted), chunk)
    merged = network.weight_maps_from_posts(df, accepted, chunk, fan)

    def rows(maps):
        return sorted((r["question_id"], r["chunk"], r["chunks"], sorted(r["users"].items())) for r in maps.collect())

    assert rows(merged) == rows(summed)


def test_no_posts_give_no_maps(make_posts):
    df = make_posts([])
    assert network.weight_maps_from_posts(df, network.accepted_answers(df)).collect() == []


def test_dumps_are_written_compressed(spark, tmp_path):
    parts = spark.range(40).selectExpr("concat('b', id % 4) as p_brand")
    parts.write.parquet(str(tmp_path / "part.parquet"))
    tags = corpus.json_dump(spark, str(tmp_path), "tags")
    assert all(file.endswith(".json.gz") for file in tags.inputFiles())
    assert sorted(map(tuple, tags.collect())) == [(f"b{i}", f"b{i}", "10") for i in range(4)]


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def test_posts_are_dealt_by_question_only(spark, case):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        weights = network.participation(case, network.accepted_answers(case))
        assert set(exchanges(weights)) == {"question_id"}
        kept = staged_by_key(spark, weights, "weights", "question_id", dealt=True)
        assert exchanges(network.user_links(kept, largest=4)) == ["first, second"]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, weights.collect()))


def test_an_answer_named_twice_counts_twice(spark, case):
    accepted = spark.createDataFrame([("q1", "a1"), ("q1", "a1"), ("q1", "a2")], "question_id string, accepted_answer_id string")
    rows = {tuple(r) for r in network.participation(case, accepted).where("question_id = 'q1'").collect()}
    assert rows == {("q1", "A", 4, 1), ("q1", "B", 6, 2), ("q1", "C", 3, 1), ("q1", "D", 2, 1)}


def test_links_are_ranked_where_they_are_summed(spark, case):
    accepted = network.accepted_answers(case)
    weights = network.participation(case, accepted)
    heads = recommend.bag_heads(recommend.open_bags(weights, accepted))
    found = recommend.top_neighbors(weights, heads, k=1, largest=4)
    assert "first, second" not in exchanges(found)
    links = {(r.user_id, r.neighbor_id): r.weight for r in network.user_links(weights).collect()}
    assert found.count() == len({user for user, _ in links})
    assert all(links[r.user_id, r.neighbor_id] == r.weight for r in found.collect())


def test_classes_go_by_their_smallest_user(spark):
    hot = spark.createDataFrame(
        [("q", "b", 2), ("q", "a", 2), ("q", "c", 3), ("p", "c", 2), ("q", "d", 2)],
        "question_id string, user_id string, weight long",
    )
    found = recommend._hot_profiles(hot).collect()
    assert {r.user_id: r.class_id for r in found} == {"a": "a", "b": "a", "d": "a", "c": "c"}
