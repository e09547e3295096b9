"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import staged


def link(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Join the sets of ``left[i]`` and ``right[i]``; the root of a set is its smallest index."""
    while len(left):
        parent = flat(parent)
        a, b = parent[left], parent[right]
        apart = a != b
        if not apart.any():
            break
        left, right = left[apart], right[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
    return parent


def flat(parent: np.ndarray) -> np.ndarray:
    while True:
        above = parent[parent]
        if np.array_equal(above, parent):
            return parent
        parent = above


def _measure(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """The smallest vertex that each vertex of ``edges`` (u, v long) can reach.

    Returns vertex, root for every vertex that is not a root itself. Each round
    links the larger neighbours of a vertex to its smallest one, then the
    smaller neighbours; sizes of neighbourhoods don't matter, as minima are
    combined before the shuffle and rows of a busy vertex stay single rows. The
    links are written once per round; the number of rounds is logarithmic.
    """
    spark = edges.sparkSession
    now = staged(
        spark,
        edges.where("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    before, measure = None, _measure(now)
    while measure[0] and measure != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        large = staged(spark, large, "large-stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = staged(spark, small, "small-stars")
        before, measure = measure, _measure(now)
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
