"""Raw dumps to clean, typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askgraph import schemas
from askgraph.functions import int_or_zero, required, split_tags, strict_int


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the schema's columns, cast them and check the required ones.

    Parquet readers see every column as nullable, so the check is part of the
    projection: it costs no extra pass.
    """
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = required(value, field.name, field.dataType)
        columns.append(value.alias(field.name))
    return df.select(columns)


def clean_users(raw: DataFrame) -> DataFrame:
    numbers = ["reputation", "upVotes", "downVotes", "views"]
    return conform(raw.withColumns({n: strict_int(n) for n in numbers}), schemas.USERS)


def clean_tags(raw: DataFrame) -> DataFrame:
    return conform(raw.withColumns({"count": strict_int("count")}), schemas.TAGS)


def clean_comments(raw: DataFrame) -> DataFrame:
    return conform(raw, schemas.COMMENTS)


def clean_questions(raw: DataFrame) -> DataFrame:
    """Questions in the posts layout; no accepted answer is ``""``, not null."""
    return raw.withColumns(
        {
            "postTypeId": strict_int("postTypeId"),
            "tags": split_tags("tags"),
            "score": strict_int("score"),
            "acceptedAnswerId": F.coalesce("acceptedAnswerId", F.lit("")),
            "favoriteCount": int_or_zero("favoriteCount"),
            "viewCount": strict_int("viewCount"),
        }
    )


def clean_answers(raw: DataFrame) -> DataFrame:
    """Answers in the posts layout; title, accepted answer and views stay null."""
    return raw.withColumns(
        {
            "postTypeId": strict_int("postTypeId"),
            "tags": split_tags("tags"),
            "score": strict_int("score"),
            "favoriteCount": int_or_zero("favoriteCount"),
        }
    )


def clean_posts(raw_questions: DataFrame, raw_answers: DataFrame) -> DataFrame:
    """Both kinds of posts in one table, those without an owner dropped.

    The owner test is on the raw column, so it reaches the JSON scan.
    """
    owned = F.col("ownerUserId").isNotNull()
    both = clean_questions(raw_questions.where(owned)).unionByName(
        clean_answers(raw_answers.where(owned)), allowMissingColumns=True
    )
    return conform(both, schemas.POSTS)
