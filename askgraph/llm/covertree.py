"""Near-duplicate vectors by dual traversal of cover trees.

Vectors are compared within a label. A label with more vectors than a shard
holds is cut by the upper levels of a cover tree: a node's rows go to the nearest
center of a net of half its radius, and each child gets the exact radius that
covers its rows, until nodes fit a shard. Pairs of those nodes are opened level
by level from the root and dropped where centers and covering radii rule links
out, so only shards that can hold a pair ever meet. Below, each shard becomes a
cover tree of the same kind, and each pair of shards left is a task that walks
two trees at once on the chord distance of unit vectors:

* nodes further apart than the threshold and both radii have no pair below them;
* nodes closer than the threshold less both radii link all that lies below
  them, so crowds of near copies are counted and joined without being paired;
* other pairs are opened, the wider node first, down to single vectors, whose
  cosine decides.

Equal vectors are one class with a weight. A task returns, per class it linked,
a number of links and one link to the smallest member of its group there, so
its output is bounded by its input.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askgraph.llm.common import staged
from askgraph.llm.components import components, flat, link
from askgraph.llm.top_k import usable

THRESHOLD = 0.93
SHARD_ROWS = 2048
#: Rounding allowance of a bound on chord distances; closer cases are opened.
SLACK = 1e-7
#: Upper levels: children of a node, rows its net is drawn from (about), rows a task deals out.
FAN = 64
NET_ROWS = 512
PIECE_ROWS = 16384
#: After so many levels, or below this radius, a node's rows are dealt to shards by hash.
LEVELS = 8
FLAT = 1e-6
_ROWS = 512
_HERE = ["label", "dim", "node"]


def chord(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Distances between unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (left @ right.T)))


class CoverTree:
    """Nodes as arrays: center (row), radius, first and last child, first and last row below.

    ``order`` lists rows so that those below a node are next to each other. A
    node without children is a single row.
    """

    def __init__(self, points: np.ndarray, weights: np.ndarray):
        self.points, self.weights = points, weights
        self.center: list[int] = [0]
        self.radius: list[float] = [0.0]
        self.children: list[tuple[int, int]] = [(0, 0)]
        self.span: list[tuple[int, int]] = [(0, len(points))]
        self.order = np.arange(len(points))
        todo = [0]
        while todo:
            todo += self._open(todo.pop())
        self.center, self.radius = np.array(self.center), np.array(self.radius)
        self.children, self.span = np.array(self.children), np.array(self.span)
        self.weight_before = np.concatenate([[0], np.cumsum(weights[self.order])])

    def _open(self, node: int) -> range:
        """Give a node its radius and, if it has several rows, the next net as children."""
        start, stop = self.span[node]
        rows = self.order[start:stop]
        if len(rows) < 2:
            return range(0)
        center = self.center[node]
        away = chord(self.points[rows], self.points[center : center + 1])[:, 0]
        self.radius[node] = float(away.max()) + 1e-12
        limit = self.radius[node] / 2
        first, at = len(self.center), start
        near = away <= limit
        if near.all():  # copies but for rounding: part them by hand
            near = rows == center
        pieces = [(center, rows[near])]
        rest = rows[~near]
        while len(rest):
            middle = rest[0]
            near = chord(self.points[rest], self.points[middle : middle + 1])[:, 0] <= limit
            near[0] = True
            pieces.append((middle, rest[near]))
            rest = rest[~near]
        for middle, members in pieces:
            self.order[at : at + len(members)] = members
            self.center.append(int(middle))
            self.radius.append(0.0)
            self.children.append((0, 0))
            self.span.append((at, at + len(members)))
            at += len(members)
        self.children[node] = (first, len(self.center))
        return range(first, len(self.center))

    def weight(self, nodes: np.ndarray) -> np.ndarray:
        return self.weight_before[self.span[nodes, 1]] - self.weight_before[self.span[nodes, 0]]


class DualWalk:
    """Links between two trees, or within one: counts per row and groups of rows."""

    def __init__(self, left: CoverTree, right: CoverTree, threshold: float):
        self.left, self.right, self.same = left, right, left is right
        self.cosine = threshold
        self.limit = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
        n = len(left.points)
        self.shift = 0 if self.same else n
        self.parent = np.arange(n if self.same else n + len(right.points))
        self.counts = (np.zeros(n + 1, "i8"), np.zeros(len(right.points) + 1, "i8"))
        self.whole = (set(), set())
        root = np.array([0])
        todo = [(root, root)]
        while todo:
            todo += self._compare(*todo.pop())
        self._join_whole()

    def _count(self, side: int, nodes: np.ndarray, weights: np.ndarray) -> None:
        """All rows below the nodes gain links: noted at both ends of their span."""
        span = (self.left, self.right)[side].span[nodes]
        np.add.at(self.counts[side], span[:, 0], weights)
        np.add.at(self.counts[side], span[:, 1], -weights)

    def _linked(self, a: np.ndarray, b: np.ndarray) -> None:
        self._count(0, a, self.right.weight(b))
        if not self.same:
            self._count(1, b, self.left.weight(a))
        self.whole[0].update(a[self.left.radius[a] > 0].tolist())
        self.whole[1].update(b[self.right.radius[b] > 0].tolist())
        self.parent = link(
            self.parent, self.left.center[a], self.right.center[b] + self.shift
        )

    def _compare(self, a: np.ndarray, b: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        more = []
        left, right = self.left, self.right
        for start in range(0, len(a), _ROWS):
            mine = a[start : start + _ROWS]
            dots = left.points[left.center[mine]] @ right.points[right.center[b]].T
            away = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * dots))
            reach = left.radius[mine][:, None] + right.radius[b][None, :]
            single = reach == 0
            inside = np.where(single, dots >= self.cosine, away + reach <= self.limit - SLACK)
            i, j = np.nonzero(inside)
            if len(i):
                self._linked(mine[i], b[j])
            open_ = ~inside & ~single & (away - reach <= self.limit + SLACK)
            wide_left = left.radius[mine][:, None] >= right.radius[b][None, :]
            for row in np.flatnonzero((open_ & wide_left).any(axis=1)):
                low, high = left.children[mine[row]]
                more.append((np.arange(low, high), b[open_[row] & wide_left[row]]))
            for column in np.flatnonzero((open_ & ~wide_left).any(axis=0)):
                low, high = right.children[b[column]]
                more.append((mine[open_[:, column] & ~wide_left[:, column]], np.arange(low, high)))
        return more

    def _join_whole(self) -> None:
        """Rows below nodes that linked as a whole are in one group."""
        for side, tree in enumerate((self.left, self.right)):
            for node in self.whole[side]:
                start, stop = tree.span[node]
                rows = tree.order[start:stop] + side * self.shift
                self.parent = link(self.parent, rows, np.full(len(rows), rows[0]))

    def links(self, side: int) -> np.ndarray:
        tree = (self.left, self.right)[side]
        out = np.zeros(len(tree.points), "i8")
        out[tree.order] = np.cumsum(self.counts[side])[:-1]
        return out


def unit(vectors: pd.Series) -> np.ndarray:
    """Vectors scaled to length 1, a row each."""
    matrix = np.array(vectors.tolist(), dtype="f8").reshape(len(vectors), -1)
    matrix /= np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))


def _net(fan: int, shard_rows: int):
    def net(rows: pd.DataFrame) -> pd.DataFrame:
        """Centers of a node's children: the furthest row each, until half the radius is covered.

        Not more than twice the children that its rows need, as each costs pairs.
        """
        points = unit(rows.sort_values(["draw", "rep"], kind="stable")["vector"])
        limit = rows["radius"].iloc[0] / 2
        most = min(fan, 2 * math.ceil(rows["size"].iloc[0] / shard_rows))
        chosen, away = [0], chord(points, points[:1])[:, 0]
        while len(chosen) < most:
            furthest = int(away.argmax())
            if away[furthest] <= (limit if len(chosen) > 1 else FLAT):
                break
            chosen.append(furthest)
            away = np.minimum(away, chord(points, points[furthest : furthest + 1])[:, 0])
        first = rows.iloc[0]
        return pd.DataFrame(
            {
                "label": first["label"],
                "dim": first["dim"],
                "node": first["node"],
                "child": [f"{first['node']}{i:02x}" for i in range(len(chosen))],
                "center": [points[i].tolist() for i in chosen],
            }
        )

    return net


def _to_nearest(rows: pd.DataFrame, centers: pd.DataFrame) -> pd.DataFrame:
    """Rows with the nearest child and their distance to its center."""
    centers = centers.sort_values("child")
    if len(rows):
        away = chord(unit(rows["vector"]), unit(centers["center"]))
        rows = rows.assign(
            node=centers["child"].to_numpy()[away.argmin(axis=1)], away=away.min(axis=1)
        )
    return rows[["label", "dim", "node", "rep", "n", "vector", "away"]]


def upper_levels(
    spark: SparkSession, classes: DataFrame, shard_rows: int, fan: int = FAN
) -> tuple[DataFrame, list[DataFrame]]:
    """Rows with their shard (node, part), and the nodes of each level.

    Every level is one pass over the rows whose node is still too large. A net
    is drawn from about ``NET_ROWS`` rows of its node; that shapes shards only,
    as every row is dealt to a child and counts for its radius. A node is named
    by the children on the way to it. Crowds that no net can part, and what is
    left after ``LEVELS``, are dealt to parts of a node by hash.
    """
    columns = ["label", "dim", "node", "rep", "n", "vector"]
    rows = classes.select("*", F.lit("").alias("node"), F.lit(2.0).alias("away")).select(*columns, "away")
    draw = F.xxhash64("rep", "vector")
    shards, levels, centers = [], [], None
    for level in range(LEVELS + 1):
        sizes = rows.groupBy(*_HERE).agg(F.count("*").alias("size"), F.max("away").alias("radius"))
        wide = (F.col("size") > shard_rows) & (F.col("radius") > FLAT) & F.lit(level < LEVELS)
        sizes = sizes.withColumn("wide", wide).withColumn(
            "parts",
            F.when(wide, F.lit(1)).otherwise(F.ceil(F.col("size") / F.lit(shard_rows))).cast("int"),
        )
        sizes = staged(spark, sizes, "nodes")
        if centers is None:
            named = sizes.withColumn("parent", F.lit(None).cast("string")).withColumn(
                "center", F.lit(None).cast("array<double>")
            )
        else:
            parents = centers.select("label", "dim", F.col("node").alias("parent"), F.col("child").alias("node"), "center")
            named = sizes.join(parents, _HERE)
        levels.append(named.select(*_HERE, "parent", "center", "radius", "parts"))
        sized = rows.join(sizes, _HERE)
        part = F.pmod(draw, F.col("parts")).cast("int").alias("part")
        shards.append(sized.where("not wide").select(*columns, part))
        if sizes.where("wide").isEmpty():
            break
        opened = sized.where("wide")
        every = F.ceil(F.col("size") / F.lit(NET_ROWS))
        sample = opened.where(F.pmod(F.xxhash64("rep", "vector", F.lit(level)), every) == 0)
        centers = staged(
            spark,
            sample.select(*columns, "radius", "size", draw.alias("draw"))
            .groupBy(*_HERE)
            .applyInPandas(_net(fan, shard_rows), "label string, dim int, node string, child string, center array<double>"),
            "centers",
        )
        pieces = F.ceil(F.col("size") / F.lit(PIECE_ROWS))
        mine = opened.select(*columns, "away", F.pmod(draw, pieces).alias("piece"))
        theirs = centers.join(sizes.where("wide").select(*_HERE, "size"), _HERE).select(
            *_HERE, "child", "center", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1)).alias("piece")
        )
        rows = staged(
            spark,
            mine.groupBy(*_HERE, "piece")
            .cogroup(theirs.groupBy(*_HERE, "piece"))
            .applyInPandas(
                _to_nearest,
                "label string, dim int, node string, rep long, n long, vector array<double>, away double",
            ),
            "dealt",
        )
    return reduce(DataFrame.unionByName, shards), levels


def shard_pairs(levels: list[DataFrame], threshold: float) -> DataFrame:
    """Pairs of shards that can hold a link: label, dim, node and part of either side.

    Starts with each label's root and opens both nodes of a pair at once. A pair
    of children goes on if their centers are no further apart than the threshold
    and both covering radii.
    """
    limit = math.sqrt(max(0.0, 2.0 - 2.0 * threshold))
    node = F.struct("node", "center", "radius", "parts")
    pairs = levels[0].select("label", "dim", node.alias("a"), node.alias("b"))
    dot = F.aggregate(F.zip_with("a.center", "b.center", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    away = F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * dot))
    near = away - F.col("a.radius") - F.col("b.radius") <= F.lit(limit + SLACK)
    same = F.col("a.node") == F.col("b.node")
    for nodes in levels[1:]:
        kids = nodes.groupBy("label", "dim", "parent").agg(F.collect_list(node).alias("kids"))
        for side in ("a", "b"):
            mine = kids.select(
                F.col("label").alias("_label"), F.col("dim").alias("_dim"), F.col("parent").alias("_parent"), F.col("kids").alias(f"_{side}")
            )
            on = (F.col("label") == F.col("_label")) & (F.col("dim") == F.col("_dim"))
            pairs = pairs.join(mine, on & (F.col(f"{side}.node") == F.col("_parent")), "left").drop("_label", "_dim", "_parent")
        pairs = (
            pairs.withColumn("_same", same)
            .withColumn("a", F.explode(F.coalesce("_a", F.array("a"))))
            .withColumn("b", F.explode(F.coalesce("_b", F.array("b"))))
            .where(same | (near & (~F.col("_same") | (F.col("a.node") < F.col("b.node")))))
            .select("label", "dim", "a", "b")
        )
    part = {side: F.explode(F.sequence(F.lit(0), F.col(f"{side}.parts") - 1)) for side in ("a", "b")}
    return (
        pairs.withColumn("part_a", part["a"])
        .withColumn("part_b", part["b"])
        .where(~same | (F.col("part_a") <= F.col("part_b")))
        .select("label", "dim", F.col("a.node").alias("node_a"), "part_a", F.col("b.node").alias("node_b"), "part_b")
    )


def _blob(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep", kind="stable")
    return pd.DataFrame(
        {
            **{name: [rows[name].iloc[0]] for name in (*_HERE, "part")},
            "reps": [rows["rep"].to_numpy("<i8").tobytes()],
            "weights": [rows["n"].to_numpy("<i8").tobytes()],
            "matrix": [unit(rows["vector"]).tobytes()],
        }
    )


def pair_walker(threshold: float):
    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["node", "part"])
        reps = [np.frombuffer(x, "<i8") for x in rows["reps"]]
        weights = [np.frombuffer(x, "<i8") for x in rows["weights"]]
        dim = int(rows["dim"].iloc[0])
        points = [
            np.frombuffer(x, "<f8").reshape(len(y), dim)
            for x, y in zip(rows["matrix"], reps, strict=True)
        ]
        trees = [CoverTree(p, w) for p, w in zip(points, weights, strict=True)]
        found = DualWalk(trees[0], trees[-1], threshold)
        counts = [found.links(side) for side in range(len(trees))]
        if found.same:
            counts[0] = counts[0] - weights[0]  # a class meets itself once
        ids, counts = np.concatenate(reps), np.concatenate(counts)
        parent = flat(found.parent)
        # the smallest id of a group stands for it
        least = np.full(len(ids), np.iinfo("i8").max)
        np.minimum.at(least, parent, ids)
        keep = (counts > 0) | (least[parent] != ids)
        return pd.DataFrame({"rep": ids, "links": counts, "root": least[parent]})[keep]

    return walk


def near_duplicate_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Vectors with their number of links and group: vec_id, n_links, component_id, kept.

    Vectors of equal label link if their cosine, in double precision, is at
    least ``threshold`` (above 0). component_id is the smallest vec_id that
    links lead to; ``kept`` marks the vector that has it.

    A null label, and a vector that is null, empty, zero or holds null or
    non-finite components, links with nothing: 0 links, a group of its own.
    Vectors of different lengths don't link. vec_id is taken for a key: rows
    that share one count as linked rows of one vertex if their vectors link,
    and a null vec_id never links. An empty table gives no rows. Other columns
    are ignored.
    """
    spark = vectors.sparkSession
    raw = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.when(usable(F.col(vector_col)), raw).alias("vector"),
    )
    zero = F.forall("vector", lambda x: x == 0)
    links = F.col("vector").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = rows.withColumn("links", F.coalesce(links & ~zero, F.lit(False)))
    rows = staged(spark, rows, "vectors")
    classes = staged(
        spark,
        rows.where("links")
        .groupBy("label", "vector")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"))
        .withColumn("dim", F.size("vector")),
        "classes",
    )
    dealt, levels = upper_levels(spark, classes, shard_rows)
    blobs = staged(
        spark,
        dealt.groupBy(*_HERE, "part").applyInPandas(
            _blob,
            "label string, dim int, node string, part int, reps binary, weights binary, matrix binary",
        ),
        "shards",
    )
    pairs = shard_pairs(levels, threshold)
    sides = F.array_distinct(
        F.array(
            *(
                F.struct(F.col(f"node_{side}").alias("node"), F.col(f"part_{side}").alias("part"))
                for side in ("a", "b")
            )
        )
    )
    met = pairs.select("*", F.inline(sides)).join(blobs, [*_HERE, "part"])
    found = staged(
        spark,
        met.groupBy("label", "dim", "node_a", "part_a", "node_b", "part_b").applyInPandas(
            pair_walker(threshold), "rep long, links long, root long"
        ),
        "pairs",
    )
    counts = found.groupBy(F.col("rep").alias("_rep")).agg(F.sum("links").alias("_links"))
    roots = components(found.where("rep <> root").select(F.col("rep").alias("u"), F.col("root").alias("v")))
    joined = (
        classes.join(counts, F.col("rep") == F.col("_rep"), "left")
        .join(roots, F.col("rep") == F.col("vertex"), "left")
        .select(
            F.col("label").alias("_label"),
            F.col("vector").alias("_vector"),
            (F.coalesce("_links", F.lit(0)) + F.col("n") - 1).alias("_n"),
            F.coalesce("root", "rep").alias("_root"),
        )
    )
    linked = rows.where("links").join(
        joined, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector"))
    )
    alone = rows.where("not links").select(
        "vec_id", F.lit(0).cast("long").alias("_n"), F.col("vec_id").alias("_root")
    )
    return (
        linked.select("vec_id", "_n", "_root")
        .unionByName(alone)
        .select(
            "vec_id",
            F.col("_n").alias("n_links"),
            F.col("_root").alias("component_id"),
            F.col("vec_id").eqNullSafe(F.col("_root")).alias("kept"),
        )
    )


SQL = """
with recursive v as (
  select vec_id, label, embedding::double[] as e
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as u, b.vec_id as v
  from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_inner_product(a.e, b.e)
        / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93
), reach as (
  select vec_id as u, vec_id as v from embeddings
  union
  select r.u, l.v from reach r join links l on r.v = l.u
), c as (
  select u as vec_id, min(v) as component_id from reach group by u
), n as (
  select u as vec_id, count(*) as n_links from links group by u
)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, c.component_id,
       e.vec_id = c.component_id as kept
from embeddings e join c using (vec_id) left join n using (vec_id)
"""
