import random

import brute
import pytest
from pyspark.sql import functions as F

from askgraph.operators import network

PAIRS = {("A", "B"): 13, ("A", "C"): 12, ("A", "D"): 6, ("B", "C"): 13, ("B", "D"): 5, ("C", "D"): 4}
LINKS = {**PAIRS, **{(v, u): w for (u, v), w in PAIRS.items()}}


def as_dict(df, value="weight"):
    keys = [c for c in df.columns if c != value]
    rows = df.collect()
    result = {tuple(r[k] for k in keys): r[value] for r in rows}
    assert len(result) == len(rows)
    return result


@pytest.fixture(scope="module")
def weights(case):
    return network.participation(case, network.accepted_answers(case))


def crowd(size=60, seed=5):
    """One question that nearly everyone takes part in, and some small ones."""
    rng = random.Random(seed)
    posts = [("q0", 1, "u0", None, "x1"), ("q1", 1, "u1", None, "")]
    posts += [(f"q{i}", 1, f"u{rng.randrange(size)}", None, "") for i in range(2, 12)]
    for i in range(size):
        posts.append((f"x{i}", 2, f"u{i}", "q0", None))
        posts.append((f"y{i}", 2, f"u{rng.randrange(size)}", f"q{rng.randrange(12)}", None))
        posts.append((f"z{i}", 2, f"u{rng.randrange(size)}", "q1", None))
    return posts


def test_accepted_answers(case):
    assert [tuple(r) for r in network.accepted_answers(case).collect()] == [("q1", "a1")]


def test_interactions_keep_repeats(case):
    rows = sorted(map(tuple, network.interactions(case).collect()))
    assert rows == sorted(
        [("A", "q1"), ("A", "q2"), ("B", "q1"), ("B", "q2"), ("C", "q1"), ("C", "q2"), ("C", "q2"),
         ("C", "q3"), ("C", "q3"), ("D", "q1")]
    )


def test_bags(case):
    rows = network.user_question_bags(case).collect()
    assert {r["user_id"]: r["questions"] for r in rows} == {
        "A": ["q1", "q2"], "B": ["q1", "q2"], "C": ["q1", "q2", "q2", "q3", "q3"], "D": ["q1"],
    }


def test_bag_of_other_post_types_is_empty_and_null_parents_are_dropped(make_posts):
    posts = make_posts([("p", 5, "A", None, None), ("a", 2, "B", None, None)])
    rows = network.user_question_bags(posts).collect()
    assert sorted((r["user_id"], r["questions"]) for r in rows) == [("A", []), ("B", [])]
    assert network.interactions(posts).count() == 0


def test_long_bags_come_in_chunks(make_posts):
    posts = [(f"a{i}", 2, "A", f"q{i * 7 % 30:02}", None) for i in range(50)]
    posts.append(("b", 2, "B", "q", None))
    rows = network.user_question_bags(make_posts(posts), chunk=9).collect()
    mine = sorted((r["chunk"], r["questions"]) for r in rows if r["user_id"] == "A")
    assert [len(q) for _, q in mine] == [9, 9, 9, 9, 9, 5]
    assert sum((q for _, q in mine), []) == sorted(p[3] for p in posts[:50])
    assert [r["chunk"] for r in rows if r["user_id"] == "B"] == [0]


def test_weights(weights):
    assert as_dict(weights.drop("posts")) == {
        ("q1", "A"): 4, ("q1", "B"): 3, ("q1", "C"): 2, ("q1", "D"): 2,
        ("q2", "A"): 2, ("q2", "B"): 4, ("q2", "C"): 4, ("q3", "C"): 6,
    }
    assert dict(weights.dtypes)["weight"] == "bigint"


def test_weight_maps_equal_weights(weights, case):
    maps = network.question_weight_maps(weights)
    merged = network.merged_question_weight_maps(case, network.accepted_answers(case))
    for df in (maps, merged):
        flat = df.select("question_id", F.explode("users").alias("user_id", "weight"))
        assert as_dict(flat) == as_dict(weights.drop("posts"))


def test_chunked_maps_hold_every_user_once(make_posts):
    posts = make_posts(crowd())
    accepted = network.accepted_answers(posts)
    weights = network.participation(posts, accepted)
    expected = as_dict(weights.drop("posts"))
    for maps in (
        network.question_weight_maps(weights, chunk=8),
        network.merged_question_weight_maps(posts, accepted, chunk=8),
    ):
        assert maps.agg(F.max("chunk")).first()[0] > 0
        flat = maps.select("question_id", F.explode("users").alias("user_id", "weight"))
        assert as_dict(flat) == expected
    chunked = network.question_weight_maps(weights, chunk=8)
    assert as_dict(network.user_links_from_maps(chunked)) == dict(brute.links(crowd()))


def test_links(weights):
    assert as_dict(network.user_links(weights)) == LINKS
    assert as_dict(network.user_links(weights, largest=4)) == LINKS
    assert as_dict(network.user_links_from_maps(network.question_weight_maps(weights))) == LINKS


@pytest.mark.parametrize("block", [1, 7, 2000])
def test_crowded_questions_keep_every_link(make_posts, block):
    posts = crowd()
    df = make_posts(posts)
    weights = network.participation(df, network.accepted_answers(df))
    found = as_dict(network.user_links(weights, block=block))
    assert found == dict(brute.links(posts))
    assert all(found[v, u] == w for (u, v), w in found.items())
    assert min(found.values()) >= 4


@pytest.mark.parametrize("block", [5, 2000])
def test_circles_are_the_links_of_the_requested(spark, make_posts, block):
    posts = crowd()
    df = make_posts(posts)
    weights = network.participation(df, network.accepted_answers(df))
    requests = spark.createDataFrame([("u3",), ("u9",), ("u9",), ("nobody",)], "user_id string")
    found = as_dict(network.circles(weights, requests, block=block))
    assert found == {k: w for k, w in brute.links(posts).items() if k[0] in ("u3", "u9")}


def test_linked_users(make_posts):
    posts = crowd() + [("alone", 1, "hermit", None, "")]
    df = make_posts(posts)
    weights = network.participation(df, network.accepted_answers(df))
    linked = {r[0] for r in network.linked_users(weights).collect()}
    assert linked == {u for u, _ in brute.links(posts)}
    assert network.largest_question(weights) == 60
