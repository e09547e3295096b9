"""Question-and-answer tables read out of an order database.

Customers stand for users, orders for questions, line items for answers, parts'
brands for tags and events for comments.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from askgraph.session import new_path, shared_folder
from askgraph.sources.tables import read_raw


def _load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _text(name: str) -> F.Column:
    return F.col(name).cast("string")


def _answer_id() -> F.Column:
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return F.concat_ws("-", *[_text(k) for k in keys])


def users(spark: SparkSession, folder: str) -> DataFrame:
    def tally(kind: str, name: str) -> F.Column:
        return F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0)).alias(name)

    seen = (
        _load(spark, folder, "events")
        .groupBy("user_id")
        .agg(tally("purchase", "up"), tally("error", "down"), tally("view", "seen"))
    )
    return (
        _load(spark, folder, "customer")
        .join(_load(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(seen, F.col("user_id") == F.col("c_custkey"), "left")
        .select(
            _text("c_custkey").alias("id"),
            F.col("c_name").alias("name"),
            F.lit("").alias("age"),
            F.lit("").alias("creationDate"),
            F.col("n_name").alias("location"),
            F.floor("c_acctbal").cast("int").alias("reputation"),
            F.coalesce("up", F.lit(0)).cast("int").alias("upVotes"),
            F.coalesce("down", F.lit(0)).cast("int").alias("downVotes"),
            F.coalesce("seen", F.lit(0)).cast("int").alias("views"),
        )
    )


def answers(spark: SparkSession, folder: str, buckets: int | None = None) -> DataFrame:
    """Answers; dealt over ``buckets`` partitions by their question where given."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    items, order, question = _load(spark, folder, "lineitem"), [], _text("l_orderkey")
    if buckets:
        items, order = items.repartition(buckets, question), [question.alias("_order")]
        question = F.col("_order")
    return (
        items.groupBy(*order, *keys)
        .agg(
            F.min("l_shipdate").alias("shipped"),
            F.min("l_returnflag").alias("flag"),
            F.min("l_linestatus").alias("status"),
        )
        .select(
            _answer_id().alias("id"),
            F.lit(2).alias("postTypeId"),
            F.lit(None).cast("string").alias("title"),
            F.concat(F.lit("answer "), _answer_id()).alias("body"),
            F.col("shipped").cast("date").cast("string").alias("postDate"),
            F.expr("cast((l_partkey * 3) div 4 as string)").alias("ownerUserId"),
            F.concat_ws("|", "flag", "status").alias("tags"),
            F.col("l_linenumber").alias("score"),
            F.lit(None).cast("string").alias("acceptedAnswerId"),
            question.alias("parentId"),
            F.lit(0).alias("favoriteCount"),
            F.lit(None).cast("int").alias("viewCount"),
        )
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    # Answer ids of a question begin alike: the least is told from what follows.
    rest = F.concat_ws("-", *[_text(k) for k in ("l_linenumber", "l_partkey", "l_suppkey")])
    first = (
        _load(spark, folder, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min(rest).alias("_rest"))
        .select(
            "l_orderkey",
            F.concat_ws("-", _text("l_orderkey"), F.nullif("_rest", F.lit(""))).alias("first_id"),
        )
    )
    closed = F.when(F.col("o_orderstatus") == "F", F.coalesce("first_id", F.lit("")))
    return (
        _load(spark, folder, "orders")
        .join(first, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            _text("o_orderkey").alias("id"),
            F.lit(1).alias("postTypeId"),
            F.concat(F.lit("Order "), _text("o_orderkey")).alias("title"),
            F.concat(F.lit("question "), _text("o_orderkey")).alias("body"),
            F.col("o_orderdate").cast("date").cast("string").alias("postDate"),
            _text("o_custkey").alias("ownerUserId"),
            F.concat_ws("|", "o_orderpriority", "o_orderstatus").alias("tags"),
            (F.col("o_orderkey") % 100).cast("int").alias("score"),
            closed.otherwise(F.lit("")).alias("acceptedAnswerId"),
            F.lit(None).cast("string").alias("parentId"),
            (F.col("o_orderkey") % 20).cast("int").alias("favoriteCount"),
            (F.col("o_orderkey") % 1000).cast("int").alias("viewCount"),
        )
    )


def posts(spark: SparkSession, folder: str, buckets: int | None = None) -> DataFrame:
    """All questions and answers; ``tags`` stays the joined string.

    With ``buckets`` both are dealt over so many partitions by their question. A
    line item goes there before it becomes an answer, so answers move once.
    """
    asked = questions(spark, folder)
    if buckets:
        asked = asked.repartition(buckets, "id")
    return asked.unionByName(answers(spark, folder, buckets))


def tags(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _load(spark, folder, "part")
        .groupBy("p_brand")
        .agg(F.count("*").cast("int").alias("count"))
        .select(F.col("p_brand").alias("id"), F.col("p_brand").alias("tagName"), "count")
    )


def comments(spark: SparkSession, folder: str) -> DataFrame:
    return _load(spark, folder, "events").select(
        _text("event_id").alias("id"),
        F.col("props").alias("text"),
        F.col("ts").cast("date").cast("string").alias("creationDate"),
        _text("event_id").alias("postId"),
        _text("user_id").alias("userId"),
    )


def feed_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Users seen in the event log, i.e. those who would open their feed."""
    return _load(spark, folder, "events").select(_text("user_id").alias("user_id")).distinct()


def _all_text(df: DataFrame) -> DataFrame:
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


def raw_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Questions as the dump has them: strings, with missing owners and counts."""
    number = F.col("id").cast("bigint")
    df = _all_text(questions(spark, folder).drop("parentId"))
    return df.withColumns(
        {
            "ownerUserId": F.when(number % 50 != 7, F.col("ownerUserId")),
            "acceptedAnswerId": F.nullif("acceptedAnswerId", F.lit("")),
            "favoriteCount": F.when(number % 3 != 0, F.col("favoriteCount")),
        }
    )


def raw_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    if name == "posts_questions":
        return raw_questions(spark, folder)
    if name == "posts_answers":
        drop = ["title", "acceptedAnswerId", "viewCount"]
        return _all_text(answers(spark, folder).drop(*drop))
    return _all_text({"users": users, "tags": tags, "comments": comments}[name](spark, folder))


#: Dumps are text that repeats its field names in every row: a tenth of it is left.
DUMP_CODEC = "gzip"

#: What a dump in the other spelling calls the fields of questions and answers.
MAPPED = {
    "postTypeId": "post_type_id",
    "postDate": "creation_date",
    "ownerUserId": "owner_user_id",
    "acceptedAnswerId": "accepted_answer_id",
    "parentId": "parent_id",
    "favoriteCount": "favorite_count",
    "viewCount": "view_count",
}


def json_dump(spark: SparkSession, folder: str, name: str, mapped: bool = False) -> DataFrame:
    """The raw table written as a JSON dump in the shared folder and read back.

    Written once per application and source: later calls read the same dump, as
    long as it is there. ``mapped`` dumps spell the names of fields in MAPPED
    the other way, and are read with that mapping.
    """
    source = folder.rstrip("/").replace(":", "").replace("/", "_") + "-mapped" * mapped
    base = f"{shared_folder(spark)}/dump-{spark.sparkContext.applicationId}-{source}"
    raw = raw_table(spark, folder, name)
    fields = {k: v for k, v in MAPPED.items() if mapped and k in raw.columns}
    try:
        return read_raw(spark, base, name, fields)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    raw.withColumnsRenamed(fields).write.json(f"{base}/{name}.json", compression=DUMP_CODEC)
    return read_raw(spark, base, name, fields)


def _digit(name: str = "id") -> F.Column:
    """First hex digit of the id's digest: the same rows on every engine."""
    return F.substring(F.md5(name), 1, 1)


def mixed_dump(spark: SparkSession, folder: str, name: str) -> str:
    """The raw table written as a dump half of whose rows spell fields as in MAPPED.

    Returns the folder of the dump.
    """
    base = new_path(spark, "mixed-dump")
    raw = raw_table(spark, folder, name)
    raw.where(_digit() < "8").write.json(f"{base}/{name}.json", compression=DUMP_CODEC)
    renamed = raw.where(_digit() >= "8").withColumnsRenamed(MAPPED)
    renamed.write.mode("append").json(f"{base}/{name}.json", compression=DUMP_CODEC)
    return base


def with_faults(raw: DataFrame) -> DataFrame:
    """Raw posts of which a quarter break the contract, by the digit of their id.

    0: a score that is no number; 1: no body; 2: neither score nor body; 3: a
    fraction as favorite count.
    """
    digit = _digit()
    return raw.withColumns(
        {
            "score": F.when(digit == "0", F.lit("n/a")).when(digit != "2", F.col("score")),
            "body": F.when(~digit.isin("1", "2"), F.col("body")),
            "favoriteCount": F.when(digit == "3", F.lit("1.5")).otherwise(F.col("favoriteCount")),
        }
    )
