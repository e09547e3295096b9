"""Merkle manifest of a dataset: leaves per source, source roots, one root, proofs.

A tree has nodes of 16 children. It is cut into blocks, aligned subtrees of
4,096 leaves at most; the roots of blocks are the leaves of the next layer, which
is cut the same way until one node is left. A block keeps all its nodes in one
array in van Emde Boas order: the upper half of its levels first, then the
subtrees below one after another, each laid out the same way. Where a node lies
follows from its level and place by arithmetic alone, so construction and the
search for siblings walk the array without pointers.

A block is a row, so a tree of any size is many rows and no task holds more than
one block at a time. Paths go down layer by layer: the path of a block's root is
joined to the block, which extends it to each of its leaves.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import staged
from askgraph.operators.blocks import with_positions

#: Children of a node; levels of a block above its leaves.
FAN, LEVELS = 16, 3
_DIGEST = 32


def tree_size(height: int) -> int:
    """Nodes of a full tree of ``height`` levels."""
    return (FAN**height - 1) // (FAN - 1)


def address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Van Emde Boas addresses of the nodes ``index`` of a level, ``depth`` levels below the root.

    The tree of ``height`` levels is cut at half height. A node of the upper part
    has its address there; others lie in one of the subtrees behind it.
    """
    if height == 1:
        return np.zeros(len(index), "i8")
    upper = height // 2
    if depth < upper:
        return address(upper, depth, index)
    below = height - upper
    width = FAN ** (depth - upper)
    subtree, inside = index // width, index % width
    return tree_size(upper) + subtree * tree_size(below) + address(below, depth - upper, inside)


@lru_cache(maxsize=256)
def _level_addresses(height: int, depth: int) -> np.ndarray:
    return address(height, depth, np.arange(FAN**depth))


def _combine(children: list[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Block:
    """An aligned subtree: ``heights`` levels of nodes above ``leaves`` leaves in one array."""

    def __init__(self, leaves: int, levels: int, nodes: np.ndarray | None = None):
        self.levels = levels
        self.counts = [leaves]
        for _ in range(levels):
            self.counts.append(-(-self.counts[-1] // FAN))
        if nodes is None:
            used = max(int(self.places(level)[-1]) for level in range(levels + 1)) + 1
            nodes = np.zeros((used, _DIGEST), "u1")
        self.nodes = nodes

    def places(self, level: int) -> np.ndarray:
        """Addresses of the nodes of a level, leaves being level 0."""
        return _level_addresses(self.levels + 1, self.levels - level)[: self.counts[level]]

    def digests(self, level: int) -> list[str]:
        """The nodes of a level, left to right."""
        text = self.nodes[self.places(level)].tobytes().hex()
        return [text[i : i + 2 * _DIGEST] for i in range(0, len(text), 2 * _DIGEST)]

    @classmethod
    def build(cls, leaves: list[bytes], levels: int) -> Block:
        block = cls(len(leaves), levels)
        block.nodes[block.places(0)] = np.frombuffer(b"".join(leaves), "u1").reshape(-1, _DIGEST)
        for level in range(levels):
            below = block.digests(level)
            above = bytes.fromhex("".join(_combine(below[i : i + FAN]) for i in range(0, len(below), FAN)))
            block.nodes[block.places(level + 1)] = np.frombuffer(above, "u1").reshape(-1, _DIGEST)
        return block

    def paths(self) -> list[list[tuple[int, list[str]]]]:
        """Per leaf and level: the place in the run and the siblings there, left to right."""
        runs = []
        for level in range(self.levels):
            nodes = self.digests(level)
            runs.append([nodes[i : i + FAN] for i in range(0, len(nodes), FAN)])
        out = []
        for leaf in range(self.counts[0]):
            path, at = [], leaf
            for level in runs:
                run, place = level[at // FAN], at % FAN
                path.append((place, run[:place] + run[place + 1 :]))
                at //= FAN
            out.append(path)
        return out


def levels_above(n: int, most: int = LEVELS) -> int:
    """Levels from ``n`` nodes to one, at most ``most``: a lone node is its own root."""
    levels = 0
    while n > 1 and levels < most:
        n, levels = -(-n // FAN), levels + 1
    return levels


_BLOCK = "_key string, _block long, _nodes binary, _leaves int, _levels int, _top binary"


def _build(rows):
    """A block's row from its leaves; a tree of several blocks has all levels in each.

    The first of several blocks is full, and a full block has all levels anyway.
    """
    digests = [d for _, d in sorted(zip(rows["_position"].to_pylist(), rows["_digest"].to_pylist(), strict=True))]
    levels = LEVELS if rows["_block"][0].as_py() else levels_above(len(digests))
    block = Block.build(digests, levels)
    top = block.nodes[block.places(levels)].tobytes()
    return pa.table(
        {
            "_key": [rows["_key"][0].as_py()],
            "_block": pa.array([rows["_block"][0].as_py()], pa.int64()),
            "_nodes": pa.array([block.nodes.tobytes()], pa.binary()),
            "_leaves": pa.array([len(digests)], pa.int32()),
            "_levels": pa.array([levels], pa.int32()),
            "_top": pa.array([top], pa.binary()),
        }
    )


def _layers(nodes: DataFrame, name: str) -> list[DataFrame]:
    """Blocks of trees, layer above layer, from leaves ``(_key, _position, _digest)``.

    Positions of a key are 0, 1, ... without a gap. Layers end where each key
    has one block, whose top is the key's root.
    """
    spark, layers = nodes.sparkSession, []
    while True:
        placed = nodes.withColumn("_block", F.floor(F.col("_position") / FAN**LEVELS))
        blocks = placed.groupBy("_key", "_block").applyInArrow(_build, _BLOCK)
        layers.append(staged(spark, blocks, name))
        if layers[-1].where("_block > 0").isEmpty():
            return layers
        # A key of one block is done: its root goes up as it is.
        nodes = layers[-1].select("_key", F.col("_block").alias("_position"), F.col("_top").alias("_digest"))


_PATH = "array<struct<place:int,siblings:string>>"
_PATH_TYPE = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.string())]))


def _block_of(row: dict) -> Block:
    nodes = np.frombuffer(row["_nodes"], "u1").reshape(-1, _DIGEST)
    return Block(row["_leaves"], row["_levels"], nodes)


def _descend(rows):
    """A block with the path of its root: the paths of its leaves, which are blocks below."""
    row = rows.to_pylist()[0]
    paths = [
        [{"place": place, "siblings": "".join(siblings)} for place, siblings in own] + row["_path"]
        for own in _block_of(row).paths()
    ]
    first = row["_block"] * FAN**LEVELS
    return pa.table(
        [
            [row["_key"]] * len(paths),
            pa.array(range(first, first + len(paths)), pa.int64()),
            pa.array(paths, _PATH_TYPE),
        ],
        ["_key", "_block", "_path"],
    )


def _extended(layer: DataFrame, paths: DataFrame) -> DataFrame:
    return (
        layer.join(paths, ["_key", "_block"])
        .groupBy("_key", "_block")
        .applyInArrow(_descend, f"_key string, _block long, _path {_PATH}")
    )


def _paths_to_blocks(layers: list[DataFrame], above: DataFrame) -> DataFrame:
    """``(_key, _block, _path)`` of the lowest blocks, from the paths ``above`` the keys' roots."""
    paths = above.select("_key", F.lit(0).cast("long").alias("_block"), "_path")
    for layer in reversed(layers[1:]):
        paths = _extended(layer, paths)
    return paths


def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """A document's leaf: SHA-256 of its fields, each with its length; ``-`` stands for null."""
    return F.unhex(F.sha2(F.concat(*(_field(c) for c in (doc_id, source, lang, n_chars, text))), 256))


def _key_of(source: Column) -> Column:
    """Sources as keys that are never null, in the same order: null first, then by bytes."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


class Manifest:
    """The stored tree of a dataset.

    ``leaves``: per document the key of its source, the position there, doc_id,
    leaf and changed leaf. ``layers``: blocks of the source trees, lowest first.
    ``sources``: the place of each key among the sources. ``top``: blocks of the
    tree over the source roots.
    """

    def __init__(self, leaves: DataFrame, layers: list[DataFrame], sources: DataFrame, top: list[DataFrame]):
        self.leaves, self.layers, self.sources, self.top = leaves, layers, sources, top

    def subroots(self) -> DataFrame:
        """``(_key, subroot)`` of each source, in hex."""
        return self.layers[-1].select("_key", F.lower(F.hex("_top")).alias("subroot"))

    def root(self) -> str | None:
        """The dataset's root in hex; None for an empty dataset."""
        row = self.top[-1].select(F.lower(F.hex("_top"))).first()
        return row and row[0]


def build_manifest(
    docs: DataFrame, tampered: Column | None = None, changed_text: Column | None = None
) -> Manifest:
    """Hash all documents and build the tree over them, stored in the shared folder.

    Leaves of a source ascend by doc_id, null ids first, equal ids by leaf.
    Sources are in order of their names' bytes, null first. Repeated rows are
    leaves each. An empty table has no root. Only doc_id, source, lang, n_chars
    and text are read; further columns are ignored, whatever their names.
    ``changed_text`` gives the text that a document where ``tampered`` holds has
    now; its leaf is kept beside the true one, for checks that must fail.
    """
    spark = docs.sparkSession
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.lit(None).cast("binary")
    if tampered is not None:
        changed = F.when(tampered, leaf_digest(*fields, changed_text))
    hashed = docs.select(
        _key_of(F.col("source")).alias("_key"),
        "doc_id",
        leaf_digest(*fields, F.col("text")).alias("leaf"),
        changed.alias("changed"),
        # Tells repeated rows apart, so that ranges can split them; which of them comes first is all one.
        F.monotonically_increasing_id().alias("_tie"),
    )
    order = [F.col("doc_id"), F.col("leaf"), F.col("_tie")]
    leaves = with_positions(staged(spark, hashed, "hashed"), "_key", order)
    leaves = staged(spark, leaves.drop("_tie"), "leaves")
    layers = _layers(leaves.select("_key", F.col("position").alias("_position"), F.col("leaf").alias("_digest")), "blocks")
    roots = layers[-1].select(F.lit("").alias("_all"), "_key", "_top")
    sources = staged(spark, with_positions(roots, "_all", [F.col("_key")]), "sources")
    top = _layers(
        sources.select(
            F.col("_all").alias("_key"), F.col("position").alias("_position"), F.col("_top").alias("_digest")
        ),
        "top",
    )
    return Manifest(leaves, layers, sources.select("_key", "position"), top)


def _proofs(rows, blocks):
    """The documents of a block with its nodes and upper path: proofs and recomputed roots."""
    block_row = blocks.to_pylist()[0]
    width = 2 * _DIGEST
    upper = [
        (s["place"], [s["siblings"][i : i + width] for i in range(0, len(s["siblings"]), width)])
        for s in block_row["_path"]
    ]
    above = "".join(s["siblings"] for s in block_row["_path"]).encode()
    block, out = _block_of(block_row), []
    docs = rows.sort_by("position").to_pylist()
    for doc, leaf, own in zip(docs, block.digests(0), block.paths(), strict=True):
        proof = hashlib.sha256("".join("".join(s) for _, s in own).encode())
        proof.update(above)
        node = leaf if doc["changed"] is None else doc["changed"].hex()
        for place, siblings in own + upper:
            node = _combine([*siblings[:place], node, *siblings[place:]])
        out.append((leaf, block_row["subroot"], proof.hexdigest(), node))
    ids = pa.array([d["doc_id"] for d in docs], pa.int64())
    return pa.table([ids, *map(list, zip(*out, strict=True))], ["doc_id", "leaf", "subroot", "proof_sha256", "folded_root"])


def proofs(manifest: Manifest) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` per document.

    ``proof_sha256`` is over the siblings from the leaf up to the root,
    ``folded_root`` the root that the document's present leaf leads to with
    them; it is ``verified`` where that is the root. Null and repeated ids and
    repeated rows are kept, each row at a place of its own.
    """
    start = manifest.top[-1].select("_key", F.array().cast(_PATH).alias("_path"))
    over_top = _extended(manifest.top[0], _paths_to_blocks(manifest.top, start))
    of_sources = over_top.select(F.col("_block").alias("position"), "_path").join(manifest.sources, "position")
    blocks = (
        manifest.layers[0]
        .join(_paths_to_blocks(manifest.layers, of_sources), ["_key", "_block"])
        .join(manifest.subroots(), "_key")
    )
    block = F.floor(F.col("position") / FAN**LEVELS).alias("_block")
    docs = manifest.leaves.select("_key", block, "position", "doc_id", "changed")
    found = (
        docs.groupBy("_key", "_block")
        .cogroup(blocks.groupBy("_key", "_block"))
        .applyInArrow(
            _proofs, "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
        )
    )
    root = F.lit(manifest.root())
    return found.select(
        "doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def audited(docs: DataFrame) -> DataFrame:
    """Proofs after a trial tampering: ids whose CRC-32 five divides have their A-Z lower-cased."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return proofs(build_manifest(docs, tampered, F.translate("text", _UPPER, _UPPER.lower())))


def _sql_levels(name: str, levels: int) -> str:
    """Tables <name>1 .. of the levels above <name>0 (k, i, h), each with the siblings of a node."""
    parts = []
    for level in range(levels):
        parts.append(f"""
{name}{level}s as materialized (
    select *, count(*) over (partition by k) as c,
           coalesce(string_agg(h, '') over (partition by k, i // 16 order by i
                    rows between unbounded preceding and 1 preceding), '') as l,
           coalesce(string_agg(h, '') over (partition by k, i // 16 order by i
                    rows between 1 following and unbounded following), '') as r from {name}{level}),
{name}{level + 1} as materialized (
    select k, i // 16 as i, case when c > 1 then sha256(string_agg(h, '' order by i)) else min(h) end as h
    from {name}{level}s group by k, c, i // 16),""")
    return "".join(parts)


def _sql(levels: int = 5, top_levels: int = 3) -> str:
    """For sources of up to 16 ** levels documents and 16 ** top_levels sources."""
    fields = "doc_id::varchar", "source", "lang", "n_chars::varchar", "{text}"
    leaf = " || ".join(f"case when {f} is null then '-' else strlen({f}) || ':' || {f} end" for f in fields)
    changed = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    steps = [("n", x) for x in range(levels)] + [("t", x) for x in range(top_levels)]
    joins, folds, proof = "", "", []
    for number, (name, level) in enumerate(steps):
        side = f"{name}{level}s"
        place = f"d.i // {16**level}" if name == "n" else f"o.i // {16**level}"
        key = "d.k" if name == "n" else "''"
        joins += f"\n    join {side} s{number} on s{number}.k = {key} and s{number}.i = {place}"
        proof.append(f"s{number}.l || s{number}.r")
        folds += f"""
f{number + 1} as (select * replace (
    case when c{number} > 1 then sha256(l{number} || x || r{number}) else x end as x) from f{number}),"""
    sides = ", ".join(f"s{n}.l as l{n}, s{n}.r as r{n}, s{n}.c as c{n}" for n in range(len(steps)))
    return f"""
with hashed as materialized (
    select doc_id, coalesce('=' || source, '') as k, sha256({leaf.format(text='text')}) as leaf,
           xor(list_reduce(list_concat([4294967295::bigint],
                       list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
                   lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
                                   lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 5 = 0 as tampered,
           sha256({leaf.format(text=changed)}) as changed
    from documents),
docs as materialized (
    select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 as i from hashed),
n0 as (select k, i, leaf as h from docs),{_sql_levels('n', levels)}
order_of as materialized (select k, row_number() over (order by k) - 1 as i, h from n{levels}),
t0 as (select '' as k, i, h from order_of),{_sql_levels('t', top_levels)}
f0 as (
    select d.doc_id, d.leaf, o.h as subroot, sha256({' || '.join(proof)}) as proof_sha256,
           case when d.tampered then d.changed else d.leaf end as x, {sides}
    from docs d join order_of o on o.k = d.k{joins}),{folds}
root as (select h from t{top_levels})
select doc_id, leaf, subroot, root.h as root, proof_sha256, x as folded_root, x = root.h as verified
from f{len(steps)}, root
"""


#: Holds for sources of up to 16 ** 5 documents and 16 ** 3 sources.
SQL = _sql()
