"""Exact top-k search by tiled matrix products.

Vectors are cut into shards and queries into blocks. Each (block, shard) pair
is a tile: one matrix product and a partial selection of the k best per query.
The lists of the tiles are merged in a tree: level by level, lists of 16
neighbouring shards or groups become one, until one is left. No task holds more
than a tile or 16 lists of a query, and between tiles only k rows per query move.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import staged

SHARD_ROWS = 8192
QUERY_ROWS = 2048
FAN_IN = 16


def whole_numbers(vector: Column, scale: float) -> Column:
    """Components as floor(scale * x), x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(math.inf)),
    )
    return vector.isNotNull() & finite


def _blob(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id", kind="stable")
    matrix = np.array(rows["vector"].tolist(), dtype="<i8").reshape(len(rows), -1)
    return pd.DataFrame(
        {
            "dim": [rows["dim"].iloc[0]],
            "part": [rows["part"].iloc[0]],
            "ids": [rows["id"].to_numpy("<i8").tobytes()],
            "matrix": [matrix.tobytes()],
        }
    )


def _blobs(vectors: DataFrame, parts: int) -> DataFrame:
    """One row per part of at most a few thousand vectors, so that tiles move few rows."""
    dealt = vectors.withColumn("part", F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int"))
    return dealt.groupBy("dim", "part").applyInPandas(
        _blob, "dim int, part int, ids binary, matrix binary"
    )


def _products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products: by floating point where every sum fits its 53 bits."""
    width = max(1, left.shape[1])
    largest = max(1, int(np.abs(left).max(initial=0))) * max(1, int(np.abs(right).max(initial=0)))
    if largest * width < 2**53:
        return (left.astype("f8") @ right.astype("f8").T).astype("i8")
    return left @ right.T


def _best(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int):
    """The k best columns of each row but its own; ``ids`` ascend, so ties take the first."""
    lists = []
    take = min(k, scores.shape[1])
    for row, me in zip(scores, own, strict=True):
        other = np.flatnonzero(ids != me)
        values = row[other]
        if len(values) > take:
            limit = np.partition(values, len(values) - take)[len(values) - take]
            above = np.flatnonzero(values > limit)
            level = np.flatnonzero(values == limit)[: take - len(above)]
            chosen = np.sort(np.concatenate([above, level]))
        else:
            chosen = np.arange(len(values))
        lists.append((values[chosen], ids[other[chosen]]))
    return lists


def tile_search(k: int):
    def search(tile: pd.DataFrame) -> pd.DataFrame:
        shards, blocks = tile[~tile["is_query"]], tile[tile["is_query"]]
        if shards.empty or blocks.empty:
            return pd.DataFrame({"query_id": [], "copy": [], "shard": [], "best": []})
        dim = int(tile["dim"].iloc[0])
        ids, queries = (np.frombuffer(x["ids"].iloc[0], "<i8") for x in (shards, blocks))
        rows, wanted = (
            np.frombuffer(x["matrix"].iloc[0], "<i8").reshape(len(y), dim)
            for x, y in ((shards, ids), (blocks, queries))
        )
        copies = pd.Series(queries).groupby(queries).cumcount().to_numpy()
        out = []
        for start in range(0, len(queries), 256):
            part = slice(start, start + 256)
            found = _best(_products(wanted[part], rows), ids, queries[part], k)
            for query, copy, (scores, others) in zip(
                queries[part], copies[part], found, strict=True
            ):
                best = [
                    {"score": int(s), "vec_id": int(v)} for s, v in zip(scores, others, strict=True)
                ]
                block = int(blocks["part"].iloc[0])
                out.append((int(query), f"{block}-{copy}", int(shards["part"].iloc[0]), best))
        return pd.DataFrame(out, columns=["query_id", "copy", "shard", "best"])

    return search


def _merged(lists: DataFrame, keys: list[str], k: int) -> DataFrame:
    ordered = F.array_sort(
        F.flatten(F.collect_list("best")),
        lambda a, b: F.when(a["score"] != b["score"], F.signum(b["score"] - a["score"]).cast("int"))
        .otherwise(F.signum(a["vec_id"] - b["vec_id"]).cast("int")),
    )
    return lists.groupBy(*keys).agg(F.slice(ordered, 1, k).alias("best"))


def exact_top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k vectors with the largest integer inner product for each query row.

    ``is_query`` marks the queries among ``vectors``; they are searched against
    all rows with another id. Returns query_id, rank (from 1), vec_id, score;
    ties go to the smaller vec_id.

    Null ids, null vectors and vectors that hold null or non-finite components
    take no part. Vectors of different lengths are not compared. A repeated row
    is a candidate, and a query, as often as it occurs. An empty table gives no
    rows. Other columns are ignored. Components beyond 2**63 / scale are not
    supported, and scores wrap beyond 64 bits.
    """
    spark = vectors.sparkSession
    rows = staged(
        spark,
        vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
            F.col(id_col).cast("long").alias("id"),
            whole_numbers(F.col(vector_col), scale).alias("vector"),
            F.size(vector_col).alias("dim"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        ),
        "vectors",
    )
    sizes = rows.agg(F.count("*"), F.count_if("is_query")).first()
    shards = max(1, math.ceil(sizes[0] / shard_rows))
    blocks = max(1, math.ceil(sizes[1] / query_rows))

    def each(parts: DataFrame, name: str, count: int, query: bool) -> DataFrame:
        """Copy every part to all tiles it is in."""
        numbers = F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)
        mine = F.col("part").alias("block" if query else "shard")
        return parts.select(
            "dim", "part", "ids", "matrix", F.lit(query).alias("is_query"), mine, numbers
        )

    plain = rows.drop("is_query")
    tiles = each(_blobs(plain, shards), "block", blocks, False).unionByName(
        each(_blobs(rows.where("is_query").drop("is_query"), blocks), "shard", shards, True)
    )
    found = tiles.groupBy("dim", "shard", "block").applyInPandas(
        tile_search(k),
        "query_id long, copy string, shard int, best array<struct<score:long,vec_id:long>>",
    )
    best, left = found.withColumnRenamed("shard", "group"), shards
    while True:  # a level of the tree each time, at most FAN_IN lists into one
        best = _merged(
            best.withColumn("group", F.expr(f"group div {FAN_IN}")), ["query_id", "copy", "group"], k
        )
        left = math.ceil(left / FAN_IN)
        if left == 1:
            break
    return best.select("query_id", F.posexplode("best").alias("position", "found")).select(
        "query_id",
        (F.col("position") + 1).cast("int").alias("rank"),
        F.col("found.vec_id").alias("vec_id"),
        F.col("found.score").alias("score"),
    )


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as w
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.w, c.w)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.w) = len(c.w)
  where q.vec_id % 20 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 20
"""
