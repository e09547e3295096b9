"""Repeated passages that many shards share: what is sent, and how it is dealt."""

import random

import pytest
from pyspark.sql import functions as F

from askgraph.llm import substrings

WINDOW = 12


def removed_by_hand(texts, window):
    places = {}
    for d, text in enumerate(texts):
        words = text.split()
        for s in range(len(words) - window + 1):
            places.setdefault(tuple(words[s : s + window]), []).append((d, s))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for d, s in found:
                gone[d] |= set(range(s, s + window))
    return {d: len(g) for d, g in enumerate(gone)}


@pytest.fixture
def hot_texts():
    """A passage that all texts share between words of their own, and an end that two each share."""
    draw = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(30))
    own = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    ends = [own(20) for _ in range(30)]
    return [f"{own(25)} {passage} {own(25)} {ends[i % 30]}" for i in range(60)]


@pytest.fixture
def kept_steps(monkeypatch):
    steps, write = {}, substrings.staged
    monkeypatch.setattr(substrings, "staged", lambda s, df, name: steps.setdefault(name, write(s, df, name)))
    return steps


def test_open_windows_do_not_go_to_all_shards_of_a_hot_passage(spark, hot_texts, kept_steps):
    docs = spark.createDataFrame(list(enumerate(hot_texts)), "doc_id long, text string")
    found = substrings.remove_repeats(docs, window=WINDOW, gram=3, shard_words=150)
    got = {r["doc_id"]: r["n_removed"] for r in found.collect()}
    assert got == removed_by_hand(hot_texts, WINDOW)
    open_ = kept_steps["indexes"].where("kind = 'open'").agg(F.sum(F.length("data"))).first()[0]
    sent = kept_steps["parcels"].agg(F.sum(F.length("runs"))).first()[0]
    assert kept_steps["indexes"].where("kind = 'index'").count() > 10
    assert 0 < sent < 2 * open_


def test_a_call_takes_runs_of_bounded_size(spark, hot_texts, monkeypatch):
    monkeypatch.setattr(substrings, "PARCEL", 200)
    docs = spark.createDataFrame(list(enumerate(hot_texts)), "doc_id long, text string")
    found = substrings.remove_repeats(docs, window=WINDOW, gram=3, shard_words=150)
    assert {r["doc_id"]: r["n_removed"] for r in found.collect()} == removed_by_hand(hot_texts, WINDOW)


def test_words_that_a_text_repeats_count_for_its_shard(spark, kept_steps):
    lines = [" ".join(f"{d}x{i}" for i in range(20)) for d in range(20)]
    texts = [" ".join([line] * 20) for line in lines]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = substrings.remove_repeats(docs, window=WINDOW, gram=3, shard_words=800)
    assert all(r["n_removed"] == 400 for r in found.collect())
    shards = kept_steps["placed"].select("shard").distinct().count()
    assert shards >= 5  # 8,000 words; a few shards would hold them by distinct anchors


def test_codes_of_windows_are_the_same_in_every_shard():
    import numpy as np

    words = [b"a", b"b", b"c", b"d", b"e"]
    here = substrings.window_codes(np.array([1, 2, 3, 4, 5]), words, 3)
    there = substrings.window_codes(np.array([4, 3, 2, 1]), [b"x", b"c", b"b", b"a"], 3)
    assert here[0] == there[0] and len({*here, *there}) == 4
