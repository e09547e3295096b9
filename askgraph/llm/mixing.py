"""Mixing of sources to target weights by Sainte-Laguë apportionment.

1. Targets: the weights share the corpus size; a target stops at a multiple of
   its source's size and the excess is shared anew by weight.
2. A source's documents are dealt by hash into shards of bounded size. The
   words of a shard, its documents in seeded order, are cut into blocks of
   equal size. A source with a target above its size takes every document
   whole as often as it fits, and blocks for the rest.
3. Blocks are apportioned by highest quotients, target / (2 s + 1) for a party
   that holds s blocks: first over sources, then over the shards of a source.
4. A shard takes its quota of blocks in seeded order.

Steps 1 and 3 work on one row per source or shard.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askgraph.llm.common import staged, word_count

BLOCK_WORDS = 128
SHARD_WORDS = 200_000
SHARD_DOCS = 20_000
WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0


def sainte_lague(votes: list[float], seats: int, most: list[int]) -> list[int]:
    """Seats by highest quotients votes / (2 s + 1), ties to the first, at most ``most`` each.

    Bisection finds the least divisor whose rounded votes don't exceed the
    seats. Each party starts one seat below its own there, so that the last
    seats, and all ties among them, are settled by comparing quotients.
    """
    if sum(votes) <= 0 or seats <= 0:
        return [0] * len(votes)
    seats = min(seats, sum(most))
    voted, bound = np.asarray(votes, "f8"), np.asarray(most, "f8")

    def at(divisor: float) -> np.ndarray:
        with np.errstate(over="ignore"):
            return np.minimum(bound, np.floor(voted / divisor + 0.5))

    low, high = 0.0, 4.0 * float(voted.max())
    while low < (middle := (low + high) / 2) < high:
        if at(middle).sum() > seats:
            low = middle
        else:
            high = middle
    given = [int(s) for s in np.maximum(at(high) - 1, 0)]
    next_up = [
        (-v / (2 * s + 1), i)
        for i, (v, s, m) in enumerate(zip(votes, given, most, strict=True))
        if s < m
    ]
    heapq.heapify(next_up)
    for _ in range(seats - sum(given)):
        _, i = heapq.heappop(next_up)
        given[i] += 1
        if given[i] < most[i]:
            heapq.heappush(next_up, (-votes[i] / (2 * given[i] + 1), i))
    return given


def targets(
    sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, cap: float = CAP
) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Sources in code-point order, null last, take the weights in turn. With
    sources sorted by cap / weight, those up to some place stop at their cap
    and the others share what is left by weight.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    weighed = sources.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size").cast("double") * F.lit(cap)
    )
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    total = F.sum(F.col("source_size").cast("double")).over(everything)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rest = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (total - capped) / rest
    stops = F.col("cap") / F.col("weight") < F.col("level")
    first_open = F.min_by("level", F.when(~stops, F.col("place"))).over(everything)
    return (
        weighed.withColumn("level", level)
        .withColumn("place", F.row_number().over(by_ratio))
        .withColumn("target", F.least("cap", F.col("weight") * first_open))
        .select("source", "source_size", "target")
    )


def _source_quotas(block: int):
    def quotas(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("source", na_position="last", kind="stable").reset_index(drop=True)
        sizes = rows["source_size"].tolist()
        wanted = rows["target"].tolist()
        whole = [int(t // s) if s else 0 for t, s in zip(wanted, sizes, strict=True)]
        rest = [max(0.0, t - w * s) for t, w, s in zip(wanted, whole, sizes, strict=True)]
        most = [-(-s // block) for s in sizes]
        blocks = sainte_lague(rest, round(sum(rest) / block), most)
        return rows.assign(passes=whole, blocks=blocks).drop(columns="all")

    return quotas


def _shard_quotas(block: int):
    def quotas(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("shard", kind="stable").reset_index(drop=True)
        sizes = rows["shard_size"].tolist()
        most = [-(-s // block) for s in sizes]
        quota = sainte_lague([float(s) for s in sizes], int(rows["blocks"].iloc[0]), most)
        return rows.assign(quota=quota)

    return quotas


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    cap: float = CAP,
    block_words: int = BLOCK_WORDS,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns a row per document: doc_id, size (its words), source_size, target
    (of its source), taken (repeats counted, at most ``cap`` times the size),
    and the columns named in ``keep``, under their own names with ``_kept_``
    before them. The words that a source gives come within a block per shard
    of its target.

    A null text has size 0. A null source is a source of its own, last in
    order. Null and repeated doc_ids are rows like others. Where all sizes are
    0, targets are 0. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("_draw"),
        *(F.col(name).alias(f"_kept_{name}") for name in keep),
    )
    sized = staged(spark, rows, "sizes")
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_docs")
    )
    shares = targets(totals.drop("_docs"), weights, cap)
    schema = "source string, source_size long, target double"
    quotas = (
        shares.withColumn("all", F.lit(0))
        .groupBy("all")
        .applyInPandas(_source_quotas(block_words), f"{schema}, passes long, blocks long")
    )
    shards = F.greatest(
        F.ceil(F.col("source_size") / F.lit(SHARD_WORDS)),
        F.ceil(F.col("_docs") / F.lit(SHARD_DOCS)),
        F.lit(1),
    )
    per_source = staged(
        spark,
        quotas.join(totals.select(F.col("source").alias("_s"), "_docs"), F.col("source").eqNullSafe(F.col("_s")))
        .withColumn("shards", shards.cast("int"))
        .drop("_s", "_docs"),
        "source-quotas",
    )
    # at most one row per source, so the larger side is only spread, not sorted
    dealt = (
        sized.withColumnRenamed("source", "_source")
        .join(per_source, F.col("_source").eqNullSafe(F.col("source")))
        .withColumn("shard", F.pmod(F.col("_draw"), F.col("shards")).cast("int"))
        .drop("_source", "shards")
    )
    dealt = staged(spark, dealt, "dealt")
    filled = (
        dealt.groupBy("source", "shard", "blocks")
        .agg(F.sum("size").alias("shard_size"))
        .groupBy("source")
        .applyInPandas(
            _shard_quotas(block_words),
            "source string, shard int, blocks long, shard_size long, quota int",
        )
    )
    count = F.ceil(F.col("shard_size") / F.lit(block_words)).cast("int")
    drawn = F.transform(
        F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
        lambda b: F.struct(
            F.xxhash64(F.lit(seed), F.col("source"), F.col("shard"), b).alias("draw"), b.alias("b")
        ),
    )
    chosen = F.transform(
        F.slice(F.array_sort(drawn), F.lit(1), F.col("quota")), lambda x: x["b"]
    )
    taken_blocks = filled.select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), chosen.alias("_chosen")
    )
    stream = Window.partitionBy("source", "shard").orderBy("_draw", "doc_id", "size")
    stop = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("_stop", stop).withColumn("_start", F.col("_stop") - F.col("size"))
    joined = placed.join(
        taken_blocks,
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")),
    )
    block = F.lit(block_words)
    mine = F.sequence(
        F.floor(F.col("_start") / block) + 1, F.floor((F.col("_stop") - 1) / block) + 1
    )
    in_blocks = F.aggregate(
        F.array_intersect(F.col("_chosen"), F.transform(mine, lambda b: b.cast("int"))),
        F.lit(0).cast("long"),
        lambda sum_, b: sum_
        + F.least(F.col("_stop"), b * block)
        - F.greatest(F.col("_start"), (b - 1) * block),
    )
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("passes") * F.col("size") + in_blocks
    )
    return joined.select(
        "doc_id",
        "size",
        "source_size",
        F.coalesce("target", F.lit(0.0)).alias("target"),
        taken.cast("long").alias("taken"),
        *(f"_kept_{name}" for name in keep),
    )
