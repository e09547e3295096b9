"""Registered queries: every operator over the whole tables of a data folder.

Lists and maps come as joined text, and results that are much larger than
their input come as totals with a checksum over all rows, so that they can be
compared without moving them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askgraph.operators import feed as feeds
from askgraph.operators import contract, ingest, network, recommend, reports
from askgraph.session import new_path, staged, staged_by_key
from askgraph.sources import corpus, spellings
from askgraph.sources.tables import read_table, write_documents, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that lists of the test tables cross them; the SQL computes the same.
BAG_CHUNK, MAP_CHUNK, DOCUMENT_PAGE = 20, 3, 1000
DOCUMENT_BUCKETS, MAP_FAN = 256, 4
FRACTION = 0.1
# Users of a question that count as a crowd in the query that goes class by class.
SMALL_CROWD = 8


def _posts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    posts = corpus.posts(spark, folder)
    return posts, network.accepted_answers(posts)


def _dealt_posts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Posts that lie by their question, and closed questions, staged."""
    accepted = staged(spark, _posts(spark, folder)[1], "accepted")
    return corpus.posts(spark, folder, int(spark.conf.get("spark.sql.shuffle.partitions"))), accepted


def _weights(
    spark: SparkSession, folder: str, fraction: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Weights and closed questions, staged by question because all later steps start from them.

    Below a ``fraction`` of 1 the weights come from a sample of the posts, the
    closed questions from all of them.
    """
    posts, accepted = _dealt_posts(spark, folder)
    if fraction < 1.0:
        posts = reports.sample_by_id(posts, fraction)
    weights = network.participation(posts, accepted, dealt=True)
    return staged_by_key(spark, weights, "weights", "question_id", dealt=True), accepted


def _links(weights: DataFrame) -> DataFrame:
    return network.user_links(weights, largest=network.largest_question(weights))


def accepted_answers(spark: SparkSession, folder: str) -> DataFrame:
    return _posts(spark, folder)[1]


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    return network.interactions(corpus.posts(spark, folder))


def user_question_bags(spark: SparkSession, folder: str) -> DataFrame:
    return network.user_question_bags(corpus.posts(spark, folder), BAG_CHUNK).select(
        "user_id",
        "chunk",
        F.size("questions").alias("n"),
        F.array_join("questions", ",").alias("questions"),
    )


def question_user_weights(spark: SparkSession, folder: str) -> DataFrame:
    return network.question_user_weights(*_posts(spark, folder))


def _maps_as_text(maps: DataFrame) -> DataFrame:
    pairs = F.transform(
        F.sort_array(F.map_entries("users")), lambda e: F.concat_ws(":", e["key"], e["value"])
    )
    return maps.select(
        "question_id", "chunk", F.size("users").alias("n"), F.array_join(pairs, ",").alias("users")
    )


def question_weight_maps(spark: SparkSession, folder: str) -> DataFrame:
    weights = network.question_user_weights(*_posts(spark, folder))
    return _maps_as_text(network.question_weight_maps(weights, MAP_CHUNK))


def merged_question_weight_maps(spark: SparkSession, folder: str) -> DataFrame:
    posts, accepted = _dealt_posts(spark, folder)
    return _maps_as_text(network.merged_question_weight_maps(posts, accepted, chunk=MAP_CHUNK, dealt=True))


def user_links(spark: SparkSession, folder: str) -> DataFrame:
    return _links(_weights(spark, folder)[0])


def user_links_from_maps(spark: SparkSession, folder: str) -> DataFrame:
    weights = network.question_user_weights(*_posts(spark, folder))
    return network.user_links_from_maps(network.question_weight_maps(weights, MAP_CHUNK))


def circle_networks(spark: SparkSession, folder: str) -> DataFrame:
    weights, _ = _weights(spark, folder)
    return network.circles(weights, corpus.feed_requests(spark, folder))


def _number(text: Column) -> Column:
    """First 32 bits of a digest as a number; sums of it compare whole results."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def _links_and_bags(
    spark: SparkSession, folder: str, fraction: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """Links by neighbour and bags by owner, written so that they join as they lie."""
    weights, accepted = _weights(spark, folder, fraction)
    links = staged_by_key(spark, _links(weights), "links", "neighbor_id")
    bags = recommend.open_bags(weights, accepted)
    return links, staged_by_key(spark, bags, "bags", "neighbor_id")


def candidates(spark: SparkSession, folder: str) -> DataFrame:
    row = F.concat_ws("|", "question_id", "neighbor_id", F.col("weight").cast("string"))
    rows = recommend.candidates(*_links_and_bags(spark, folder), extra={"number": _number(row)})
    return rows.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.sum("weight").alias("total_weight"),
        F.sum("number").alias("checksum"),
    )


def _documents(
    spark: SparkSession, folder: str, each: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    return recommend.recommendations(*_links_and_bags(spark, folder), DOCUMENT_PAGE, each=each)


def _document_digest(documents: DataFrame) -> DataFrame:
    def text(entry: Column) -> Column:
        weight = entry["weight"].cast("string")
        return F.concat_ws(":", entry["question_id"], entry["neighbor_id"], weight)

    return documents.select(
        "_id",
        "user_id",
        "page",
        F.size("posts").alias("n"),
        F.md5(F.array_join(F.transform("posts", text), ",")).alias("digest"),
    )


def recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return _documents(spark, folder, _document_digest)


def _stored_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder)
    path = new_path(spark, "documents")
    write_documents(documents, "json", path=path, compression="gzip")
    return spark.read.schema(documents.schema).json(path)


def stored_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    """Documents saved as compressed JSON and read back."""
    return _document_digest(_stored_documents(spark, folder))


def feed_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The first five entries of everybody's stored documents."""
    return feeds.top_of_documents(_stored_documents(spark, folder))


def feed_requested_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The first five entries for users seen in the event log, from documents stored by user."""
    path = new_path(spark, "keyed-documents")
    feeds.write_keyed_documents(_documents(spark, folder), path, DOCUMENT_BUCKETS)
    return feeds.requested_documents(spark, path, corpus.feed_requests(spark, folder))


def question_weight_maps_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The maps per question from one map per post, merged in a tree."""
    return _maps_as_text(network.weight_maps_from_posts(*_posts(spark, folder), chunk=MAP_CHUNK, fan=MAP_FAN))


def candidates_sampled(spark: SparkSession, folder: str) -> DataFrame:
    """The candidates of the sampled analysis, row by row."""
    return recommend.candidates(*_links_and_bags(spark, folder, FRACTION))


def ranked_sampled(spark: SparkSession, folder: str) -> DataFrame:
    """The same with their places in the lists."""
    return recommend.ranked_candidates(*_links_and_bags(spark, folder, FRACTION))


def feed_top5_sampled(spark: SparkSession, folder: str) -> DataFrame:
    weights, accepted = _weights(spark, folder, FRACTION)
    return recommend.top_candidates(weights, accepted)


def feed_top5_crowds(spark: SparkSession, folder: str) -> DataFrame:
    """Everybody's best five, with questions of a few users treated as crowded, class by class."""
    weights, accepted = _weights(spark, folder)
    return recommend.top_candidates(weights, accepted, crowd=SMALL_CROWD, per_class=0)


def answer_participation_sampled(spark: SparkSession, folder: str) -> DataFrame:
    posts = reports.sample_by_id(corpus.posts(spark, folder), FRACTION)
    return reports.answer_participation(corpus.users(spark, folder), posts)


def ingest_posts_mapped(spark: SparkSession, folder: str) -> DataFrame:
    """Posts from a dump that spells its field names another way."""
    dumps = (corpus.json_dump(spark, folder, f"posts_{kind}", mapped=True) for kind in ("questions", "answers"))
    return _tags_as_text(ingest.clean_posts(*dumps))


def _top(spark: SparkSession, folder: str, requests: DataFrame | None = None) -> DataFrame:
    weights, accepted = _weights(spark, folder)
    return recommend.top_candidates(weights, accepted, requests=requests)


def feed_top5(spark: SparkSession, folder: str) -> DataFrame:
    return _top(spark, folder)


def feed(spark: SparkSession, folder: str) -> DataFrame:
    top = staged(spark, _top(spark, folder), "top")
    return feeds.feed(top, corpus.posts(spark, folder), corpus.users(spark, folder))


def feed_requested(spark: SparkSession, folder: str) -> DataFrame:
    """Feeds of the users seen in the event log."""
    top = staged(spark, _top(spark, folder, corpus.feed_requests(spark, folder)), "top")
    return feeds.feed(top, corpus.posts(spark, folder), corpus.users(spark, folder))


def feed_json(spark: SparkSession, folder: str) -> DataFrame:
    weights, accepted = _weights(spark, folder)
    top = staged(spark, recommend.top_candidates(weights, accepted), "top")
    rows = feeds.feed(
        top,
        corpus.posts(spark, folder),
        corpus.users(spark, folder),
        network.linked_users(weights),
    )
    return feeds.feed_json(rows)


def ingest_users(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.clean_users(corpus.json_dump(spark, folder, "users"))


def ingest_tags(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.clean_tags(corpus.json_dump(spark, folder, "tags"))


def ingest_comments(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.clean_comments(corpus.json_dump(spark, folder, "comments"))


def _clean_posts(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.clean_posts(
        corpus.json_dump(spark, folder, "posts_questions"),
        corpus.json_dump(spark, folder, "posts_answers"),
    )


def _tags_as_text(posts: DataFrame) -> DataFrame:
    return posts.withColumns({"n_tags": F.size("tags"), "tags": F.array_join("tags", ",")})


def ingest_posts(spark: SparkSession, folder: str) -> DataFrame:
    return _tags_as_text(_clean_posts(spark, folder))


def stored_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Clean posts written as a Parquet table and read back."""
    base = new_path(spark, "clean")
    write_table(_clean_posts(spark, folder), base, "posts")
    return _tags_as_text(read_table(spark, base, "posts"))


def ingest_posts_spelled(spark: SparkSession, folder: str) -> DataFrame:
    """Clean posts from dumps in two spellings, none of them named."""
    raw = {
        name: spellings.read_any_spelling(spark, corpus.mixed_dump(spark, folder, name), name)
        for name in ("posts_questions", "posts_answers")
    }
    return _tags_as_text(ingest.clean_posts(raw["posts_questions"], raw["posts_answers"]))


def dump_spellings(spark: SparkSession, folder: str) -> DataFrame:
    dump = corpus.mixed_dump(spark, folder, "posts_questions")
    return spellings.spellings_used(spark, dump, "posts_questions")


def _sorted_out(spark: SparkSession, folder: str) -> tuple[str, dict[str, int]]:
    path = new_path(spark, "checked-posts")
    dumps = {
        name: corpus.with_faults(corpus.json_dump(spark, folder, name))
        for name in ("posts_questions", "posts_answers")
    }
    return path, contract.sort_out(dumps, path)


def ingest_posts_accepted(spark: SparkSession, folder: str) -> DataFrame:
    """Clean posts of dumps with broken rows, which are set aside."""
    return _tags_as_text(contract.accepted(spark, _sorted_out(spark, folder)[0], "posts"))


def quarantined_posts(spark: SparkSession, folder: str) -> DataFrame:
    rows = contract.quarantine(spark, _sorted_out(spark, folder)[0], "posts")
    return rows.select(
        "id",
        "ownerUserId",
        F.array_join("broken", ", ").alias("broken"),
        F.get_json_object("record", "$.score").alias("raw_score"),
        F.get_json_object("record", "$.body").alias("raw_body"),
    )


def broken_rules(spark: SparkSession, folder: str) -> DataFrame:
    counts = _sorted_out(spark, folder)[1]
    return spark.createDataFrame(list(counts.items()), "rule string, rows long")


def peek_questions(spark: SparkSession, folder: str) -> DataFrame:
    questions = ingest.clean_questions(corpus.json_dump(spark, folder, "posts_questions"))
    return reports.peek(questions.select("id", "title", "acceptedAnswerId", "favoriteCount"), "id")


def sample_posts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sample_by_id(corpus.posts(spark, folder)).select("id")


def answer_participation(spark: SparkSession, folder: str) -> DataFrame:
    return reports.answer_participation(corpus.users(spark, folder), corpus.posts(spark, folder))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        accepted_answers,
        interactions,
        user_question_bags,
        question_user_weights,
        question_weight_maps,
        merged_question_weight_maps,
        user_links,
        user_links_from_maps,
        circle_networks,
        candidates,
        recommendations,
        stored_recommendations,
        feed_top5,
        feed,
        feed_requested,
        feed_json,
        ingest_users,
        ingest_tags,
        ingest_comments,
        ingest_posts,
        stored_posts,
        peek_questions,
        sample_posts,
        answer_participation,
        feed_from_documents,
        feed_requested_from_documents,
        question_weight_maps_merged,
        candidates_sampled,
        ranked_sampled,
        feed_top5_sampled,
        feed_top5_crowds,
        answer_participation_sampled,
        ingest_posts_mapped,
        ingest_posts_spelled,
        dump_spellings,
        ingest_posts_accepted,
        quarantined_posts,
        broken_rules,
    )
}
