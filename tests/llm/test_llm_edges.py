"""Odd tables: nulls in any column, no rows, repeated rows, long texts, more columns with clashing names."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from askgraph.llm import (
    binary, byte_bpe, covertree, merkle, mixing, packing, pii, secrets_scan, simhash, substrings, top_k, toxicity,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MORE = (
    "rank", "shard", "row", "start", "stop", "size", "target", "spans", "_k1", "_k2", "print", "root",
    "base", "weak", "vec", "dim", "part", "links", "rep", "value", "ids", "length", "piece", "kind",
)
LABELS = "doc_id long, quality int, toxic int"
ON_DOCS = {
    "packing": lambda d, l: packing.pack_best_fit(d),
    "substrings": lambda d, l: substrings.remove_repeats(d),
    "mixing": lambda d, l: mixing.mix_sources(d),
    "matrices": lambda d, l: binary.digest(binary.packed_matrices(d)),
    "secrets": lambda d, l: secrets_scan.scan_secrets(d),
    "masking": lambda d, l: secrets_scan.mask_secrets(d),
    "simhash": lambda d, l: simhash.simhash_groups(d),
    "toxicity": lambda d, l: toxicity.toxicity(d, l, steps=2),
    "manifest": lambda d, l: merkle.audited(d),
    "byte bpe": lambda d, l: byte_bpe.round_trip(d),
    "personal": lambda d, l: pii.find_personal_data(d),
}
ON_VECTORS = {
    "cover trees": covertree.near_duplicate_vectors,
    "top k": lambda v: top_k.exact_top_k(v, F.col("vec_id") >= 0, k=3),
}
ROWS = [
    (1, "a plain text of some words", "en", "s", 26),
    (1, "a plain text of some words", "en", "s", 26),
    (2, None, None, None, None),
    (None, "text without an id", "en", None, 18),
    (None, None, None, None, None),
    (3, "", "en", "s", 0),
    (4, " \t\n ", "en", "t", 4),
    (5, "x" * 200_000, "en", "t", 200_000),
    (6, "word " * 30_000, "en", "t", 150_000),
    (2**60 + 1, "😀 é 漢字 \x00  ", "xx", "u", 10),
]


@pytest.fixture(scope="module")
def odd(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    return docs.select("*", *(F.lit("more").alias(c) for c in MORE))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, None, 1), (None, 0, 1), (4, 0, None), (6, 0, 1)], LABELS)


@pytest.mark.parametrize("name", ON_DOCS)
def test_odd_documents(odd, labels, name):
    rows = ON_DOCS[name](odd, labels).collect()
    if name == "packing":
        assert sum(r["piece"] == 0 for r in rows) == len(ROWS)
    elif name == "matrices":
        assert sum(s.split(":")[1] == "0" for r in rows for s in r["segments"].split(",")) == len(ROWS)
    else:
        assert len(rows) == len(ROWS)
        order = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in rows)
        assert order == sorted((r[0] is None, r[0] or 0) for r in ROWS)


@pytest.mark.parametrize("name", ON_DOCS)
def test_no_documents(odd, labels, name):
    assert ON_DOCS[name](odd.where("false"), labels.where("false")).collect() == []


@pytest.mark.parametrize("name", ON_VECTORS)
def test_odd_vectors(spark, name):
    rows = [
        (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, None, 1), (3, [], 1), (4, [None, 1.0], 1),
        (5, [0.0, 0.0], 1), (None, [1.0, 0.0], 1), (6, [1.0, 0.0, 0.0], 1), (7, [1.0, 0.0], None),
        (8, [float("nan"), 1.0], 2), (9, [1.0, 0.01], 1),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.select("*", *(F.lit("more").alias(c) for c in MORE))
    found = ON_VECTORS[name](df).collect()
    assert ON_VECTORS[name](df.where("false")).collect() == []
    if name == "cover trees":
        assert len(found) == len(rows)
        assert {r["component_id"] for r in found if r["vec_id"] in (1, 9)} == {1}
        assert {r["n_links"] for r in found if r["vec_id"] not in (1, 9)} == {0}
    else:
        assert {r["query_id"] for r in found} <= {1, 3, 5, 6, 7, 9}


def test_one_document_of_each_group_stays(spark):
    docs = spark.createDataFrame(ROWS, DOCS)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # 2, 3 and 4 have no words, and neither has one of the two documents without an id
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 6, 2**60 + 1]
    assert ids.count(None) == 1
    assert corpus_pipeline.drop_near_copies(spark, docs.where("false"), "").count() == 0


def test_groups_of_documents_without_an_id_of_their_own(spark):
    long = " ".join(f"word{i}" for i in range(300))
    near = long + " end"
    rows = [
        (None, long, "en", "s", 1), (None, near, "en", "s", 1), (None, long, "en", "s", 1),
        (7, "some other text that is clean and stays here", "en", "s", 1),
        (7, "one id for two quite different texts of a table", "en", "s", 1),
        (9, "some other text that is clean and stays here", "fr", "s", 1),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    kept = [tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert {r for r in kept if r[0]} == {rows[3], rows[4]}
    assert len(kept) == 3 and sum(r[0] is None for r in kept) == 1
    again = corpus_pipeline.drop_near_copies(spark, docs.repartition(5), "").collect()
    assert set(kept) == set(map(tuple, again))


def test_mixed_documents_come_whole(spark):
    texts = [f"w{i} " * (1 + i % 50) for i in range(3000)]
    docs = spark.createDataFrame(
        [(i, t, "en", f"s{0 if i % 3 else i % 7}", len(t)) for i, t in enumerate(texts)], DOCS
    )
    mixed = corpus_pipeline.mix_sources(spark, docs, "").collect()
    words = [(r["doc_id"], r["source"], len(r["text"].split())) for r in mixed]
    assert all(r["text"] == texts[r["doc_id"]] for r in mixed)
    targets = mixing.mix_sources(docs, keep=("source",)).select("_kept_source", "target").distinct()
    for source, target in targets.collect():
        assert abs(sum(n for _, s, n in words if s == source) - target) <= 2 * mixing.BLOCK_WORDS + 50


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "simhash", "secrets", "mixing", "packing",
    ]
    docs = spark.createDataFrame(ROWS, DOCS)
    masked = corpus_pipeline.mask_secrets(spark, docs, "")
    assert masked.columns == docs.columns and masked.count() == len(ROWS)
