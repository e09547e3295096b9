"""What keeps shuffles, spills and repeated work of the analytics queries down."""

import re
import time

import brute
import pytest
from pyspark.sql import functions as F

from askgraph.operators import feed as feeds
from askgraph.operators import network, recommend
from askgraph.session import CLEANUP, staged, staged_by_key
from askgraph.sources import corpus
from test_layouts import exchanges
from test_network import crowd
from test_recommend import busy, documents, first, prepare, tops


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("block", [3, 2000])
def test_extra_columns_of_candidates(make_posts, block):
    _, _, links, bags = prepare(make_posts(crowd(size=25)))
    text = F.concat_ws("|", "question_id", "neighbor_id", F.col("weight").cast("string"))
    found = recommend.candidates(links, bags, block=block, extra={"text": text})
    plain = recommend.candidates(links, bags, block=block)
    assert sorted(map(tuple, found.collect())) == sorted((*r, f"{r[1]}|{r[2]}|{r[3]}") for r in plain.collect())


def test_extra_columns_leave_out_own_questions(make_posts):
    weights, _, links, bags = prepare(make_posts(busy(33)))
    found = recommend.candidates(links, bags, weights, extra={"more": F.col("weight") + 1})
    plain = recommend.candidates(links, bags, weights).collect()
    assert sorted(map(tuple, found.collect())) == sorted((*r, r[3] + 1) for r in plain)


def test_lists_are_dealt_over_as_many_tasks_as_they_need(make_posts, monkeypatch):
    posts = busy(34)
    _, _, links, bags = prepare(make_posts(posts))
    monkeypatch.setattr(recommend, "LISTED", 50)
    runs, _ = recommend.ranked_groups(links, bags)
    entries = sum(len(found) for found in brute.lists(posts).values())
    dealt = re.findall(r"Exchange hashpartitioning\(user_id#\d+, segment#\d+L?, (\d+)\)", str(runs._jdf.queryExecution().executedPlan()))
    assert dealt == [str(-(-entries // 50))]
    assert documents(recommend.recommendations(links, bags)) == brute.lists(posts)


def test_maps_are_cut_where_the_weights_lie(spark, make_posts, no_broadcast):
    df = make_posts(crowd(size=25))
    weights = network.question_user_weights(df, network.accepted_answers(df))
    maps = network.question_weight_maps(weights, chunk=4)
    assert exchanges(maps) == []


@pytest.mark.parametrize("whole", [0, 10, 100_000])
def test_maps_of_crowded_questions_are_the_same(make_posts, whole):
    df = make_posts(crowd(size=25))
    weights = network.question_user_weights(df, network.accepted_answers(df))

    def rows(maps):
        return sorted((r["question_id"], r["chunk"], r["chunks"], sorted(r["users"].items())) for r in maps.collect())

    expected = network._ordered_weight_maps(weights, 4)
    assert rows(network.question_weight_maps(weights, 4, whole)) == rows(expected)


def test_a_null_user_has_a_place_but_no_entry(spark):
    rows = [("q", None, 4), ("q", "a", 2), ("q", "b", 2), ("p", None, 4)]
    weights = spark.createDataFrame(rows, "question_id string, user_id string, weight long")
    found = network.question_weight_maps(weights, chunk=2).collect()
    assert sorted((r["question_id"], r["chunk"], r["chunks"], dict(r["users"])) for r in found) == [
        ("q", 0, 2, {"a": 2}),
        ("q", 1, 2, {"b": 2}),
    ]


def test_strongest_links_deal_no_weights_by_user(spark, make_posts, monkeypatch):
    df = make_posts(busy(35))
    weights, accepted, links, _ = prepare(df)
    kept = staged_by_key(spark, weights, "weights", "question_id", dealt=True)
    heads = recommend.bag_heads(recommend.open_bags(weights, accepted))
    monkeypatch.setattr(recommend, "PER_TASK", 20)
    found = recommend._strongest_links(kept, heads, 5)
    assert exchanges(found) == ["user_id"]
    weight = {(r["user_id"], r["neighbor_id"]): r["weight"] for r in links.collect()}
    offering = {r["neighbor_id"] for r in heads.collect()}
    best = {}
    for (u, v), w in weight.items():
        if v in offering:
            best.setdefault(u, []).append(w)
    expected = {
        (u, v, w)
        for (u, v), w in weight.items()
        if v in offering and sum(x > w for x in best[u]) < 5
    }
    assert {tuple(r) for r in found.collect()} == expected


def test_crowds_meet_their_sizes_where_they_lie(spark, make_posts, no_broadcast):
    df = make_posts(crowd(size=25))
    weights = network.participation(df, network.accepted_answers(df))
    kept = staged_by_key(spark, weights, "weights", "question_id", dealt=True)
    ordinary, profiles = recommend._split_crowds(kept, 8, 2000)
    assert exchanges(ordinary) == []
    sizes = {}
    for r in weights.collect():
        sizes[r["question_id"]] = sizes.get(r["question_id"], 0) + 1
    assert {r["question_id"] for r in ordinary.collect()} == {q for q, n in sizes.items() if n <= 8}


def test_requests_do_not_deal_the_weights_by_user(spark, make_posts, monkeypatch):
    weights, accepted, links, _ = prepare(make_posts(busy(36)))
    kept = staged_by_key(spark, weights, "weights", "question_id", dealt=True)
    # Nothing tells before the run how few users these are.
    requests = spark.range(5_000_000).select(F.concat(F.lit("u"), (F.col("id") % 4).cast("string")).alias("user_id"))
    written, real = [], network.staged_by_key

    def seen(spark, df, *rest, **more):
        written.extend(exchanges(df))
        return real(spark, df, *rest, **more)

    monkeypatch.setattr(network, "staged_by_key", seen)
    found = network.circles(kept, requests).collect()
    assert "user_id" not in written
    asked = {f"u{i}" for i in range(4)}
    assert sorted(map(tuple, found)) == sorted(tuple(r) for r in links.collect() if r["user_id"] in asked)


@pytest.mark.parametrize("block", [3, 2000])
def test_links_of_requests_are_shuffled_once(spark, make_posts, monkeypatch, block):
    silent = [("closed", 1, "u1", None, "x1"), ("x1", 2, "quiet", "closed", None), ("x2", 2, None, "closed", None)]
    weights, accepted, links, _ = prepare(make_posts(busy(37) + silent))
    kept = staged_by_key(spark, weights, "weights", "question_id", dealt=True)
    heads = recommend.bag_heads(recommend.open_bags(weights, accepted))
    requests = spark.createDataFrame([("u1",), ("u2",), ("u1",), ("quiet",), (None,)], "user_id string")
    monkeypatch.setattr(recommend, "PER_TASK", 20)
    found = recommend._strongest_in_circles(kept, accepted, requests, heads, 5, block)
    if block == 2000:
        assert exchanges(found) == ["user_id"]
    offering = {r["neighbor_id"] for r in heads.collect()}
    assert "quiet" not in offering
    rows = [tuple(r) for r in links.collect() if r["user_id"] in {"u1", "u2", "quiet"} and r["neighbor_id"] in offering]
    assert {tuple(r) for r in found.collect()} == {
        (u, v, w) for u, v, w in rows if sum(x > w for a, _, x in rows if a == u) < 5
    }


def test_posts_move_to_their_questions_once(spark, tmp_path, no_broadcast):
    orders = [(i, i % 5, "F" if i % 3 else "O", None) for i in range(40)] + [(None, 1, "F", None), (3, 2, "F", None)]
    items = [(i % 43, i % 4, i % 7, i % 2, None, "A", "F") for i in range(200)]
    items += [items[0], items[5], (None, 1, 1, 1, None, "A", "F"), (6, None, 1, 1, None, "A", "F"), (7, None, None, None, None, "A", "F")]
    tables = {
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate timestamp"),
        "lineitem": (items, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, l_returnflag string, l_linestatus string"),
    }
    for name, (rows, kind) in tables.items():
        rows = [(*r, None) if name == "orders" else r for r in rows]
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    plain = corpus.posts(spark, str(tmp_path))
    accepted = staged(spark, network.accepted_answers(plain), "accepted")
    ids = [(r["id"], r["parentId"]) for r in corpus.answers(spark, str(tmp_path)).collect()]
    least = {q: min(i for i, p in ids if p == q) for q in {p for _, p in ids}}
    assert all(least[r["question_id"]] == r["accepted_answer_id"] for r in accepted.collect())
    dealt = corpus.posts(spark, str(tmp_path), 4)
    assert sorted(map(repr, dealt.collect())) == sorted(map(repr, plain.collect()))
    found = network.participation(dealt, accepted, dealt=True)
    # Questions, line items and accepted answers of either side; sums need none.
    assert sorted(exchanges(found)) == ["cast(l_orderkey as string)", "id", "question_id", "question_id"]
    expected = network.participation(plain, accepted)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def files_of_shuffles(spark):
    kept = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {kept.apply(i).getName() for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def test_written_steps_leave_no_shuffle_files(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    before = files_of_shuffles(spark)
    assert len(staged(spark, rows, "counts").collect()) == 7
    staged_by_key(spark, rows, "counts", "k")
    written = files_of_shuffles(spark) - before
    until = time.time() + 20
    while written and time.time() < until:  # files go in the background
        time.sleep(0.2)
        written = files_of_shuffles(spark) - before
    assert not written
    assert spark.conf.get(CLEANUP, "false") == "false"


@pytest.mark.parametrize("whole", [0, 10, 100_000])
def test_merged_maps_of_crowded_questions_are_the_same(make_posts, whole):
    df = make_posts([*crowd(size=25), *busy(36)])
    accepted = network.accepted_answers(df)
    merged = network.merged_question_weight_maps(df, accepted, 4, whole)
    maps = network.question_weight_maps(network.question_user_weights(df, accepted), 4)

    def rows(found):
        return sorted((r["question_id"], r["chunk"], sorted(r["users"].items())) for r in found.collect())

    assert rows(merged) == rows(maps)


def test_merged_maps_are_cut_where_the_roles_lie(make_posts, no_broadcast):
    df = make_posts(crowd(size=25))
    assert exchanges(network.merged_question_weight_maps(df, network.accepted_answers(df), 4)) == []


@pytest.mark.parametrize("met", [1, 2, 8])
def test_maps_of_a_question_meet_where_they_lie(make_posts, no_broadcast, met):
    posts = crowd(size=25)  # seven maps of the crowded question
    df = make_posts(posts)
    maps = network.question_weight_maps(network.question_user_weights(df, network.accepted_answers(df)), chunk=4)
    links = network.user_links_from_maps(maps, met)
    found = links.collect()
    assert len(found) == len(brute.links(posts))
    assert {(r["user_id"], r["neighbor_id"]): r["weight"] for r in found} == dict(brute.links(posts))
    if met == 8:  # the sums alone
        assert {keys for keys in exchanges(links) if "_mine" not in keys} == {"first, second"}


@pytest.mark.parametrize("crowd_size", [8, 100])
def test_links_are_worked_off_in_rounds(make_posts, monkeypatch, crowd_size):
    posts = busy(38)
    df = make_posts(posts)
    accepted = network.accepted_answers(df)
    steps, write = [], recommend.staged
    monkeypatch.setattr(recommend, "ROUND", 300)
    monkeypatch.setattr(recommend, "staged", lambda s, rows, name: steps.append(name) or write(s, rows, name))
    found = recommend.top_candidates(network.participation(df, accepted), accepted, crowd=crowd_size, per_class=0)
    assert tops(found) == first(brute.lists(posts), 5)
    assert steps.count("strongest-links" if crowd_size == 100 else "classed-links") > 1


def test_posts_shown_are_written_before_they_are_joined(spark, make_posts, monkeypatch):
    steps, write = [], feeds.staged
    monkeypatch.setattr(feeds, "staged", lambda s, rows, name: steps.append((name, write(s, rows, name))) or steps[-1][1])
    columns = "id string, title string, body string, postDate string, ownerUserId string, score int, favoriteCount int, viewCount int"
    posts = spark.createDataFrame([(f"q{i}", "t", "b", "d", "u", 1, 2, 3) for i in range(5)], columns)
    kinds = "id string, name string, location string, reputation int, upVotes int, downVotes int, views int"
    users = spark.createDataFrame([("u", "n", "l", 1, 2, 3, 4)], kinds)
    top = spark.createDataFrame([("u", 1, "q3", "v", 6)], "user_id string, rank int, question_id string, neighbor_id string, weight long")
    assert [r["post_title"] for r in feeds.feed(top, posts, users).collect()] == ["t"]
    assert [(name, shown.count()) for name, shown in steps] == [("shown-posts", 1)]


@pytest.mark.parametrize("segment", [7, 100_000])
def test_documents_are_worked_off_in_rounds(make_posts, monkeypatch, segment):
    posts = [*busy(39), ("lone", 1, "solo", None, "")]
    _, _, links, bags = prepare(make_posts(posts))
    steps, write = [], recommend.staged
    monkeypatch.setattr(recommend, "ROUND", 400)
    monkeypatch.setattr(recommend, "staged", lambda s, rows, name: steps.append(name) or write(s, rows, name))
    found = recommend.recommendations(links, bags, 5, segment=segment, each=lambda rows: rows.select("*"))
    assert documents(found) == brute.lists(posts)
    assert steps.count("documents") > 1
