"""SimHash near-duplicates with vantage-point trees.

Equal fingerprints are one class. Classes are dealt over shards by the upper
levels of a vantage-point tree: each level splits by the Hamming distance to a
vantage point, near ones left, far ones right. By the triangle inequality a
class can link across the border only if its own distance is within the
threshold of it, so a class is looked for in its own shard and in the shards
behind borders that close. Within a shard the tree goes on down to small leaves,
where fingerprints are compared bit by bit. All pairs within the threshold are
found; what leaves a shard is a spanning star per group, not its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import staged, whole_ids
from askgraph.llm.components import components, flat, link

SEED = 42
SHINGLE = 4
MAX_BITS = 4
SHARD_ROWS = 8192
#: Fingerprints from which the upper levels are made; it decides on balance, not on results.
SAMPLE = 4096
LEAF = 64
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """64-bit SimHash of the lower-cased words of a text; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), "i8", len(words))
    stops = np.cumsum(lengths + 1) - 1
    starts = stops - lengths
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), stops[width - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, "i8")
    for at in range(0, len(first), _CHUNK):
        pairs = zip(first[at : at + _CHUNK], last[at : at + _CHUNK], strict=True)
        hashes = np.array([digest(line[i:j], seed) for i, j in pairs], "<u8")
        total += np.unpackbits(
            hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little"
        ).sum(axis=0, dtype="i8")
    bits = total * 2 > len(first)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id and print (the fingerprint as a signed long), a row per document."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [fingerprint(text, shingle, seed) for text in batch["text"]]
            prints = np.array(values, "u8").view("i8")
            yield pd.DataFrame({"doc_id": whole_ids(batch["doc_id"]), "print": prints})

    return docs.select(
        F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInPandas(run, "doc_id long, print long")


def distance(one: np.uint64, many: np.ndarray) -> np.ndarray:
    return np.bitwise_count(many ^ one).astype("i4")


def _vantage(points: np.ndarray) -> tuple[np.uint64, int] | None:
    """The best of a few points to split by, and the median distance; None if none splits."""
    best = None
    for point in points[:: max(1, len(points) // 5)][:5]:
        away = distance(point, points)
        middle = int(np.median(away))
        if middle == away.max():
            middle -= 1
        near = int((away <= middle).sum())
        if 0 < near < len(points):
            score = (min(near, len(points) - near), float(away.std()))
            if best is None or score > best[0]:
                best = (score, point, middle)
    return best and (best[1], best[2])


class UpperTree:
    """Upper levels as parallel lists; a child below 0 is the shard ~child."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[list] = []
        self.shards = 0
        self.root = self._build(sample, shards)

    def _build(self, points: np.ndarray, shards: int) -> int:
        found = _vantage(points) if shards > 1 and len(points) > 1 else None
        if found is None:
            self.shards += 1
            return ~(self.shards - 1)
        point, middle = found
        number = len(self.nodes)
        self.nodes.append([point, middle, 0, 0])
        near = distance(point, points) <= middle
        self.nodes[number][2] = self._build(points[near], shards // 2)
        self.nodes[number][3] = self._build(points[~near], shards - shards // 2)
        return number

    def visit(self, prints: np.ndarray, slack: int) -> list[tuple[int, np.ndarray]]:
        """(shard, indices of the prints that reach it); with slack 0 every print reaches one."""
        out, todo = [], [(self.root, np.arange(len(prints)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((~node, rows))
                continue
            point, middle, near, far = self.nodes[node]
            away = distance(point, prints[rows])
            todo.append((near, rows[away - slack <= middle]))
            todo.append((far, rows[away + slack > middle]))
        return out


def router(tree: UpperTree, bits: int):
    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            prints = batch["print"].to_numpy("i8").view("u8")
            home, rows = np.zeros(len(prints), "i8"), []
            for shard, members in tree.visit(prints, 0):
                home[members] = shard
                rows.append((shard, True, prints[members].tobytes()))
            for shard, reached in tree.visit(prints, bits):
                # of two shards that a pair spans, the later one finds it
                guests = reached[home[reached] < shard]
                if len(guests):
                    rows.append((shard, False, prints[guests].tobytes()))
            yield pd.DataFrame(rows, columns=["shard", "is_member", "prints"])

    return route


def close_pairs(
    members: np.ndarray, queries: np.ndarray, bits: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices (query, member) of all pairs within ``bits``, by a vantage-point tree of members."""
    todo = [(np.arange(len(members)), np.arange(len(queries)))]
    while todo:
        rows, asked = todo.pop()
        if not len(rows) or not len(asked):
            continue
        found = _vantage(members[rows]) if len(rows) > LEAF else None
        if found is None:
            for at in range(0, len(asked), 4096):
                some = asked[at : at + 4096]
                for part in range(0, len(rows), 1024):
                    mine = rows[part : part + 1024]
                    apart = np.bitwise_count(queries[some][:, None] ^ members[mine][None, :])
                    q, m = np.nonzero(apart <= bits)
                    yield some[q], mine[m]
            continue
        point, middle = found
        near = distance(point, members[rows]) <= middle
        away = distance(point, queries[asked])
        todo.append((rows[near], asked[away - bits <= middle]))
        todo.append((rows[~near], asked[away + bits > middle]))


def shard_linker(bits: int):
    def stars(rows: pd.DataFrame) -> pd.DataFrame:
        def together(some: pd.Series) -> np.ndarray:
            return np.frombuffer(b"".join(some), "<u8")

        members = together(rows["prints"][rows["is_member"]])
        guests = together(rows["prints"][~rows["is_member"]])
        everyone = np.concatenate([members, guests])
        parent = np.arange(len(everyone))
        for q, m in close_pairs(members, everyone, bits):
            parent = link(parent, q, m)
        parent = flat(parent)
        leaves = np.flatnonzero(parent != np.arange(len(parent)))
        signed = everyone.view("i8")
        return pd.DataFrame({"u": signed[leaves], "v": signed[parent[leaves]]})

    return stars


def simhash_groups(
    docs: DataFrame,
    shingle: int = SHINGLE,
    bits: int = MAX_BITS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Documents with their fingerprint and group: doc_id, fingerprint, component_id.

    Two documents link if their fingerprints differ in at most ``bits`` bits;
    component_id is the smallest doc_id that links lead to. Texts without words,
    and null texts, have fingerprint zero and link like any other. Null doc_ids
    are rows too; a group of null doc_ids only has a null component_id.
    Repeated rows give repeated rows. An empty table gives no rows. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    printed = staged(
        spark, fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints"
    )
    classes = staged(
        spark, printed.groupBy("print").agg(F.min("doc_id").alias("first_id")), "classes"
    )
    count = classes.count()
    sample = classes.orderBy(F.xxhash64("print"), "print").limit(SAMPLE)
    points = np.array([row["print"] for row in sample.collect()], "i8").view("u8")
    tree = UpperTree(points, max(1, math.ceil(count / shard_rows)))
    stars = (
        classes.select("print")
        .mapInPandas(router(tree, bits), "shard int, is_member boolean, prints binary")
        .groupBy("shard")
        .applyInPandas(shard_linker(bits), "u long, v long")
    )
    roots = components(stars)
    grouped = classes.join(roots, F.col("print") == F.col("vertex"), "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    grouped = staged(spark, grouped, "grouped")
    named = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    ids = grouped.join(named, "root").select(F.col("print").alias("_print"), "component_id")
    return printed.join(ids, F.col("print") == F.col("_print")).select(
        "doc_id",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
