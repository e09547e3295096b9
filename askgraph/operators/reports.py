"""Participation report, samples and the peek at a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.functions import in_hash_sample
from askgraph.schemas import ANSWER


def answer_participation(users: DataFrame, posts: DataFrame, more_than: int = 5) -> DataFrame:
    """``(users, active_users, share)``: who answered more than so many times.

    Users without an answer count as users.
    """
    answers = (
        posts.where(F.col("postTypeId") == ANSWER)
        .groupBy(F.col("ownerUserId").alias("id"))
        .agg(F.count("*").alias("answers"))
    )
    active = F.when(F.col("answers") > more_than, 1).otherwise(0)
    return (
        users.select("id")
        .join(answers, "id", "left")
        .agg(
            F.count("*").alias("users"),
            F.coalesce(F.sum(active), F.lit(0)).cast("bigint").alias("active_users"),
            F.avg(active).alias("share"),
        )
    )


def sample_rows(df: DataFrame, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Spark's Bernoulli sample: each row is drawn on its own, without replacement."""
    return df.sample(False, fraction, seed)


def sample_by_id(
    df: DataFrame, fraction: float = 0.1, seed: int = 42, name: str = "id"
) -> DataFrame:
    """The same kind of sample, but decided by the id and so the same on every run."""
    return df.where(in_hash_sample(name, fraction, seed))


def peek(df: DataFrame, *order: Column | str, n: int = 20) -> DataFrame:
    """A few rows to look at; give an order to see the same ones every time."""
    return (df.orderBy(*order) if order else df).limit(n)
