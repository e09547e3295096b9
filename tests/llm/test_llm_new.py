"""Byte-level BPE, the Merkle manifest and the filter audit against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from askgraph.llm import byte_bpe, filter_audit, merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TOKENS = ["a", "'s", "'re", "  ", "\n", " ", "word", "1", "22", " !", "?!", "é", "漢字", "\t", "'", " 　", "😀", "'ll ve"]


def odd_texts(n=150):
    rng = random.Random(1)
    mixed = ["".join(rng.choice(TOKENS) for _ in range(rng.randint(0, 300))) for _ in range(n)]
    return mixed + ["x" * 900, " " * 500, None, "", "'" * 333, "ab1" * 400, "x" * 200 + " " * 300 + "y" * 500, "x" * 700 + " hello "]


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 16), (7, 3), (200, 40), (16_384, 256)])
def test_bpe_equals_the_library_however_texts_are_cut(spark, chunk, overlap):
    texts = odd_texts()
    library = byte_bpe.codec().library
    docs = spark.createDataFrame([(i if i % 50 else None, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = []
    for i, text in enumerate(texts):
        ids = ",".join(map(str, library.encode_ordinary(text or "")))
        n = ids.count(",") + 1 if ids else 0
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (ids, text or "")]
        want.append((i if i % 50 else None, n, *digests))
    found = [tuple(r) for r in byte_bpe.round_trip(docs, chunk=chunk, overlap=overlap).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_bpe_pieces_decode_to_the_texts(spark):
    texts = odd_texts(60)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pieces = byte_bpe.decode_ids(byte_bpe.encode_texts(docs, chunk=100, overlap=20))
    parts = defaultdict(list)
    for r in sorted(pieces.collect(), key=lambda r: r["piece"]):
        parts[r["doc_id"]].append((bytes(r["decoded"]), r["ids"]))
    library = byte_bpe.codec().library
    assert max(map(len, parts.values())) > 3
    for i, text in enumerate(texts):
        assert b"".join(d for d, _ in parts[i]).decode() == (text or "")
        assert [x for _, ids in parts[i] for x in ids] == library.encode_ordinary(text or "")


def test_addresses_fill_the_array_by_halves():
    for height in range(1, 5):
        places = [merkle.address(height, d, np.arange(16**d)) for d in range(height)]
        assert sorted(np.concatenate(places)) == list(range(merkle.tree_size(height)))
    # four levels: two above, then 256 subtrees of two, each in one piece
    children = merkle.address(4, 3, np.arange(16))
    assert list(children - merkle.address(4, 2, np.array([0]))[0]) == list(range(1, 17))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """Levels of a tree from its leaves to its root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def siblings(levels, at):
    path = []
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        path.append((run[: at % 16], run[at % 16 + 1 :]))
        at //= 16
    return path


def plain_manifest(rows):
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n in rows:
        leaf = sha("".join(map(field, (doc_id, source, lang, n, text))))
        now = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0 and text is not None:
            lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            now = sha("".join(map(field, (doc_id, source, lang, n, lower))))
        by_source[source].append(((doc_id is not None, doc_id or 0), leaf, doc_id, now))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: climb([x[1] for x in sorted(by_source[s])]) for s in order}
    top = climb([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for at, (_, leaf, doc_id, now) in enumerate(sorted(by_source[source])):
            path = siblings(trees[source], at) + siblings(top, place)
            node = now
            for left, right in path:
                node = sha("".join([*left, node, *right]))
            proof = sha("".join("".join(left + right) for left, right in path))
            root = top[-1][0]
            out.append((doc_id, leaf, trees[source][-1][0], root, proof, node, node == root))
    return sorted(out, key=str)


def test_manifest_of_sources_of_all_sizes(spark):
    rng = random.Random(3)
    rows = []
    sizes = {"big": 4500, "full": 4096, None: 1, "": 17, "one": 1, "é": 256, **{f"s{i}": i for i in range(1, 20)}}
    for source, n in sizes.items():
        for _ in range(n):
            doc_id = rng.randrange(-(2**40), 2**60)
            rows.append((doc_id, rng.choice(["Aa É", "b", "", None]), rng.choice(["en", None]), source, rng.choice([1, None])))
    rows += [(7, "Same", "en", "s3", 4)] * 3 + [(None, "x", "en", "s3", 1)] * 2
    docs = spark.createDataFrame(rows, DOCS).withColumn("position", F.lit("clash")).withColumn("_key", F.lit(0))
    found = sorted((tuple(r) for r in merkle.audited(docs).collect()), key=str)
    want = plain_manifest(rows)
    assert found == want
    assert 0 < sum(r[-1] for r in found) < len(found)
    assert merkle.build_manifest(docs).root() == want[0][3]


def plain_audit(rows, labels):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    least, good, toxic = {}, set(), set()
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            least[text or ""] = min(doc_id, least.get(text or "", doc_id))
    for doc_id, q, t in labels:
        good |= {doc_id} if q == 1 else set()
        toxic |= {doc_id} if t == 1 else set()
    fails = []
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        found = words.findall(text)
        failed = {
            "A": len(found) < 50,
            "B": 100 * len(set(found)) < 65 * len(found),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > least[text],
        }
        named = doc_id is not None
        fails.append((source or "", {f for f in failed if failed[f]}, named and doc_id in good, named and doc_id in toxic))
    removed_in, out = Counter(), []
    orders = ["".join(o) for o in itertools.permutations("ABCDE")]
    parts = {p for p, *_ in fails}
    for part, order in itertools.product(parts, orders):
        own = [x for x in fails if x[0] == part]
        for step, letter in enumerate(order):
            hit = [x for x in own if letter in x[1]]
            here = [x for x in hit if not x[1] & set(order[:step])]
            removed_in[part, letter] += len(here)
            kept = sum(not x[1] & set(order[: step + 1]) for x in own)
            out.append((part, order, step + 1, kept, len(here), len(hit) - len(here), sum(x[1] == {letter} for x in own),
                        sum(x[2] for x in here), sum(x[3] for x in here)))
    return sorted((*x, removed_in[x[0], x[1][x[2] - 1]]) for x in out)


AUDIT_COLUMNS = (
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
)


def audit_rows():
    rng = random.Random(5)
    texts = [" ".join(rng.choices(["a", "b", "Cc", "#", "d", *map(str, range(90))], k=rng.randint(0, 120))) for _ in range(60)]
    rows = [(rng.randrange(300), rng.choice([*texts, None, ""]), "en", rng.choice(["s", "t", None, ""]), 1) for _ in range(250)]
    rows += [(5, texts[0], "en", "s", 1)] * 3 + [(None, texts[0], "en", "s", 1)] * 2 + [(i, texts[1], "en", "t", 1) for i in range(400)]
    labels = [(i, i % 2, i % 3 % 2) for i in range(200)] + [(3, 0, 1), (None, 1, 1), (4, None, None)]
    return rows, labels


def test_audit_of_all_orders(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, DOCS).select("*", *(F.lit("x").alias(c) for c in ("mask", "part", "h1", "n", "least")))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("y"))
    found = filter_audit.filter_audit(docs, marks, block_rows=100)
    assert sorted(map(tuple, found.select(*AUDIT_COLUMNS).collect())) == plain_audit(rows, labels)
    assert filter_audit.filter_audit(docs.where("false"), marks.where("false")).collect() == []


def test_audit_with_hashes_that_collide(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, DOCS)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    few = F.pmod(F.xxhash64("text"), F.lit(7)), F.lit(1).cast("long")
    collided = filter_audit.mask_counts(docs, marks, hashes=few).collect()
    assert sorted(map(tuple, collided)) == sorted(map(tuple, filter_audit.mask_counts(docs, marks).collect()))


def test_sketches_miss_no_repeat(spark):
    hashes = [(i * 7919 % 1000 - 500, i * 104_729 % 2**61) for i in range(3000)]
    rows = hashes + hashes[:40] * 2 + hashes[100:101] * 500
    df = spark.createDataFrame(rows, "h1 long, h2 long")
    found = {tuple(r) for r in filter_audit.possible_repeats(df, block_rows=200).collect()}
    repeated = {h for h, n in Counter(rows).items() if n > 1}
    assert repeated <= found
    assert len(found) < len(repeated) + 30
