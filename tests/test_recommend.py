import random

import brute
import pytest

from askgraph.operators import feed as feeds
from askgraph.operators import network, recommend
from test_network import crowd

LISTS = {
    "A": [("q2", "B", 13), ("q2", "C", 12), ("q2", "C", 12), ("q3", "C", 12), ("q3", "C", 12)],
    "B": [("q2", "A", 13), ("q2", "C", 13), ("q2", "C", 13), ("q3", "C", 13), ("q3", "C", 13)],
    "C": [("q2", "B", 13), ("q2", "A", 12)],
    "D": [("q2", "A", 6), ("q2", "B", 5), ("q2", "C", 4), ("q2", "C", 4), ("q3", "C", 4),
          ("q3", "C", 4)],
}


def prepare(df):
    accepted = network.accepted_answers(df)
    weights = network.participation(df, accepted)
    return weights, accepted, network.user_links(weights), recommend.open_bags(weights, accepted)


def documents(df):
    result = {}
    for row in sorted(df.collect(), key=lambda r: (r["user_id"], r["page"])):
        result.setdefault(row["user_id"], []).extend(map(tuple, row["posts"]))
    return result


def tops(df):
    result = {}
    for row in sorted(df.collect(), key=lambda r: (r["user_id"], r["rank"])):
        entry = (row["question_id"], row["neighbor_id"], row["weight"])
        result.setdefault(row["user_id"], []).append(entry)
        assert row["rank"] == len(result[row["user_id"]])
    return result


def first(lists, k):
    return {u: found[:k] for u, found in lists.items() if found}


def test_worked_case(spark, case):
    weights, accepted, links, bags = prepare(case)
    assert documents(recommend.recommendations(links, bags)) == LISTS
    flat = sorted(map(tuple, recommend.candidates(links, bags).collect()))
    assert flat == sorted((u, *e) for u, found in LISTS.items() for e in found)
    assert tops(recommend.top_candidates(weights, accepted)) == first(LISTS, 5)


def test_closed_only_users_keep_an_empty_list(spark, make_posts):
    df = make_posts(
        [("q1", 1, "A", None, "a1"), ("a1", 2, "B", "q1", None), ("a2", 2, "C", "q1", None)]
    )
    weights, accepted, links, bags = prepare(df)
    assert documents(recommend.recommendations(links, bags)) == {"A": [], "B": [], "C": []}
    assert recommend.top_candidates(weights, accepted).count() == 0


def test_own_questions_can_be_left_out(case):
    weights, _, links, bags = prepare(case)
    rows = recommend.candidates(links, bags, own=weights).collect()
    assert sorted(map(tuple, rows)) == [
        ("A", "q3", "C", 12), ("A", "q3", "C", 12), ("B", "q3", "C", 13), ("B", "q3", "C", 13),
        ("D", "q2", "A", 6), ("D", "q2", "B", 5), ("D", "q2", "C", 4), ("D", "q2", "C", 4),
        ("D", "q3", "C", 4), ("D", "q3", "C", 4),
    ]


@pytest.mark.parametrize("page", [7, 150, 100_000])
def test_documents_of_any_length(spark, make_posts, page):
    posts = crowd(size=25)
    _, _, links, bags = prepare(make_posts(posts))
    found = recommend.recommendations(links, bags, page=page, block=5)
    rows = found.collect()
    assert max(len(r["posts"]) for r in rows) <= page
    keyed = {r["_id"]: r for r in rows}  # as a store keyed on _id would hold them
    assert len(keyed) == len(rows)
    by_page = sorted(keyed.values(), key=lambda r: (r["user_id"], r["page"]))
    expected = brute.lists(posts)
    for user, entries in expected.items():
        mine = [tuple(p) for r in by_page if r["user_id"] == user for p in r["posts"]]
        assert mine == entries
    assert documents(found) == expected
    assert len(rows) == sum(max(1, -(-len(e) // page)) for e in expected.values())


@pytest.mark.parametrize(("page", "segment"), [(7, 5), (20, 64), (64, 20), (10_000, 1), (10, 100_000)])
def test_documents_from_segments_of_lists(make_posts, page, segment):
    posts = busy(21, users=12, questions=20, answers=200)
    _, _, links, bags = prepare(make_posts(posts))
    found = recommend.recommendations(links, bags, page=page, block=5, segment=segment)
    rows = found.collect()
    expected = brute.lists(posts)
    assert documents(found) == expected
    assert {r["_id"]: len(r["posts"]) for r in rows} == {
        f"{u}/{p}": min(page, len(e) - p * page) for u, e in expected.items() for p in range(max(1, -(-len(e) // page)))
    }


def test_documents_without_own_questions(make_posts):
    posts = busy(22)
    weights, _, links, bags = prepare(make_posts(posts))
    mine = {(r["user_id"], r["question_id"]) for r in weights.collect()}
    expected = {u: [e for e in found if (u, e[0]) not in mine] for u, found in brute.lists(posts).items()}
    assert documents(recommend.recommendations(links, bags, page=9, own=weights, segment=30)) == expected
    ranked = recommend.ranked_candidates(links, bags, own=weights).collect()
    assert sorted(map(tuple, ranked)) == sorted((u, i, q, v, w) for u, f in expected.items() for i, (q, v, w) in enumerate(f))


def test_bags_of_any_length_in_arrays(spark):
    rows = [("a", f"q{i}", 1) for i in range(50)] + [("a", "again", 75), ("b", "q1", 2)]
    bags = spark.createDataFrame(rows, "neighbor_id string, question_id string, repeats long")
    arrays = recommend.bag_arrays(bags, chunk=10).collect()
    assert len({(r["neighbor_id"], r["chunk"]) for r in arrays}) == len(arrays) > 10
    assert max(len(r["entries"]) for r in arrays) < 30
    found = sorted((e["neighbor_id"], e["question_id"]) for r in arrays for e in r["entries"])
    assert found == sorted((v, q) for v, q, n in rows for _ in range(n))


@pytest.mark.parametrize("block", [3, 2000])
def test_candidates_in_blocks(make_posts, block):
    posts = crowd(size=25)
    _, _, links, bags = prepare(make_posts(posts))
    rows = recommend.candidates(links, bags, block=block).collect()
    expected = [(u, q, v, w) for u, e in brute.lists(posts).items() for q, v, w in e]
    assert sorted(map(tuple, rows)) == sorted(expected)


def busy(seed, users=24, questions=14, answers=120):
    """Several crowded questions over the same users, closed ones and repeats."""
    rng = random.Random(seed)
    posts = [
        (f"q{i}", 1, f"u{rng.randrange(users)}", None, "" if rng.random() < 0.6 else f"a{i}")
        for i in range(questions)
    ]
    for i in range(answers):
        q = min(rng.randrange(questions), rng.randrange(questions), rng.randrange(questions))
        posts.append((f"a{i}", 2, f"u{rng.randrange(users)}", f"q{q}", None))
    return posts


@pytest.mark.parametrize(
    "seed, crowd_size, k", [(1, 8, 5), (2, 12, 5), (3, 1, 3), (4, 15, 1), (5, 100, 5)]
)
@pytest.mark.parametrize("per_class", [0, 2.0])
def test_top_without_the_pairs_of_crowds(make_posts, seed, crowd_size, k, per_class):
    posts = busy(seed)
    df = make_posts(posts)
    accepted = network.accepted_answers(df)
    weights = network.participation(df, accepted)
    found = recommend.top_candidates(weights, accepted, k=k, crowd=crowd_size, block=4, per_class=per_class)
    assert tops(found) == first(brute.lists(posts), k)


def test_one_question_of_everybody(make_posts):
    posts = crowd(size=60)
    df = make_posts(posts)
    accepted = network.accepted_answers(df)
    weights = network.participation(df, accepted)
    found = recommend.top_candidates(weights, accepted, crowd=20, block=16)
    assert tops(found) == first(brute.lists(posts), 5)


def test_class_path_is_taken_where_users_are_alike(make_posts, monkeypatch):
    def paths(posts):
        df = make_posts(posts)
        accepted = network.accepted_answers(df)
        weights = network.participation(df, accepted)
        taken = []
        by_class = recommend._links_with_crowds
        monkeypatch.setattr(
            recommend, "_links_with_crowds", lambda *a: taken.append("classes") or by_class(*a)
        )
        found = recommend.top_candidates(weights, accepted, crowd=4, block=8)
        assert tops(found) == first(brute.lists(posts), 5)
        monkeypatch.undo()
        return taken

    alike = [("q0", 1, "asker", None, ""), ("q1", 1, "asker", None, "")]
    alike += [(f"a{i}", 2, f"u{i}", "q0", None) for i in range(30)]
    assert paths(alike) == ["classes"]
    # user i answered q0 i + 1 times: everyone is a class of their own
    apart = [("q0", 1, "asker", None, "")]
    apart += [(f"a{i}-{j}", 2, f"u{i}", "q0", None) for i in range(12) for j in range(i + 1)]
    assert paths(apart) == []


def test_requests_restrict_the_output(spark, make_posts):
    posts = busy(9)
    df = make_posts(posts)
    accepted = network.accepted_answers(df)
    weights = network.participation(df, accepted)
    asked = spark.createDataFrame([("u2",), ("u5",), ("u2",), ("nobody",)], "user_id string")
    found = tops(recommend.top_candidates(weights, accepted, requests=asked))
    assert found == {u: e for u, e in first(brute.lists(posts), 5).items() if u in ("u2", "u5")}


def test_top_of_documents_equals_top(spark, make_posts):
    weights, accepted, links, bags = prepare(make_posts(busy(11)))
    stored = recommend.recommendations(links, bags, page=40)
    assert tops(feeds.top_of_documents(stored, 5)) == tops(
        recommend.top_candidates(weights, accepted)
    )


def test_no_closed_question_is_offered(make_posts):
    posts = busy(12)
    weights, accepted, *_ = prepare(make_posts(posts))
    top = recommend.top_candidates(weights, accepted)
    assert top.join(accepted, "question_id").count() == 0
