"""Raw and clean table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT = T.StringType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, STRING, True) for n in names])


# Raw dumps carry every value as a JSON string; fields are read by name.
RAW_USERS = _strings(
    "id", "name", "age", "creationDate", "location", "reputation", "upVotes", "downVotes", "views"
)
RAW_QUESTIONS = _strings(
    "id", "postTypeId", "title", "body", "postDate", "ownerUserId", "tags", "score",
    "acceptedAnswerId", "favoriteCount", "viewCount",
)
RAW_ANSWERS = _strings(
    "id", "postTypeId", "body", "postDate", "ownerUserId", "tags", "score", "parentId",
    "favoriteCount",
)
RAW_TAGS = _strings("id", "tagName", "count")
RAW_COMMENTS = _strings("id", "text", "creationDate", "postId", "userId")

RAW = {
    "users": RAW_USERS,
    "posts_questions": RAW_QUESTIONS,
    "posts_answers": RAW_ANSWERS,
    "tags": RAW_TAGS,
    "comments": RAW_COMMENTS,
}

USERS = _struct(
    ("id", STRING, False),
    ("name", STRING, False),
    ("age", STRING, False),
    ("creationDate", STRING, False),
    ("location", STRING, False),
    ("reputation", INT, False),
    ("upVotes", INT, False),
    ("downVotes", INT, False),
    ("views", INT, False),
)
POSTS = _struct(
    ("id", STRING, False),
    ("postTypeId", INT, False),
    ("title", STRING, True),
    ("body", STRING, False),
    ("postDate", STRING, False),
    ("ownerUserId", STRING, False),
    ("tags", T.ArrayType(STRING, False), False),
    ("score", INT, False),
    ("acceptedAnswerId", STRING, True),
    ("parentId", STRING, True),
    ("favoriteCount", INT, True),
    ("viewCount", INT, True),
)
TAGS = _struct(("id", STRING, False), ("tagName", STRING, False), ("count", INT, False))
COMMENTS = _struct(
    ("id", STRING, False),
    ("text", STRING, False),
    ("creationDate", STRING, False),
    ("postId", STRING, False),
    ("userId", STRING, False),
)

CLEAN = {"users": USERS, "posts": POSTS, "tags": TAGS, "comments": COMMENTS}

# Post types: fixed values of the data model.
QUESTION, ANSWER = 1, 2
