"""Who took part in which question, and the user network that follows from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.operators.blocks import (
    BLOCK,
    blocked_join,
    key_sizes,
    self_join_cells,
    unordered_pairs,
    with_positions,
    with_sizes,
)
from askgraph.schemas import ANSWER, QUESTION
from askgraph.session import staged, staged_by_key

# What taking part in a question counts for.
ASKED, ACCEPTED, ANSWERED = 4, 3, 2

# Entries of a list or map in one row; longer ones come in several rows.
CHUNK = 100_000
# Maps that are merged at a time.
FAN = 64
# Maps of a question that meet in one row; where it has more, they meet by twos.
MET = 8


def accepted_answers(posts: DataFrame) -> DataFrame:
    """Closed questions with the id of the accepted answer."""
    closed = (F.col("postTypeId") == QUESTION) & (F.col("acceptedAnswerId") != "")
    return posts.where(closed).select(
        F.col("id").alias("question_id"), F.col("acceptedAnswerId").alias("accepted_answer_id")
    )


def _question_of_post() -> Column:
    return F.when(F.col("postTypeId") == QUESTION, F.col("id")).when(
        F.col("postTypeId") == ANSWER, F.col("parentId")
    )


def interactions(posts: DataFrame) -> DataFrame:
    """One row per post: its owner and the question it belongs to, repeats kept."""
    return posts.select(
        F.col("ownerUserId").alias("user_id"), _question_of_post().alias("question_id")
    ).where(F.col("question_id").isNotNull())


def user_question_bags(posts: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Every user's sorted bag of questions, one array entry per post.

    Bags come in chunks of ``chunk`` entries at every size, numbered by
    ``chunk``: chunk n holds the places from n * chunk on, so the chunks of a
    user in a row are the sorted bag, and no row grows with the data. An owner
    of other post types only keeps one row with an empty bag.
    """
    entries = posts.select(
        F.col("ownerUserId").alias("user_id"), "id", _question_of_post().alias("question_id")
    )
    asked = entries.where(F.col("question_id").isNotNull())
    placed = with_positions(asked, "user_id", [F.col("question_id"), F.col("id")])
    bags = (
        placed.withColumn("chunk", F.floor(F.col("position") / chunk).cast("int"))
        .groupBy("user_id", "chunk")
        .agg(F.sort_array(F.collect_list("question_id")).alias("questions"))
    )
    nothing = F.array().cast("array<string>")
    empty = (
        entries.groupBy("user_id")
        .agg(F.count("question_id").alias("_n"))
        .where(F.col("_n") == 0)
        .select("user_id", F.lit(0).alias("chunk"), nothing.alias("questions"))
    )
    return bags.unionByName(empty)


def participation(posts: DataFrame, accepted: DataFrame, dealt: bool = False) -> DataFrame:
    """``(question_id, user_id, weight, posts)``: summed weight and number of posts.

    The weight is what links users; the number of posts is how often the
    question is in the user's bag. Both come from the same aggregate, which is
    all that later steps need of the posts.

    Posts are dealt over partitions by their question once, for the accepted
    answers, for the sums and for whoever joins on questions next. Posts that
    are ``dealt`` so already, questions by id and answers by parent, stay there.
    """
    entries = posts.select(
        "id",
        "postTypeId",
        F.col("ownerUserId").alias("user_id"),
        _question_of_post().alias("question_id"),
    ).where(F.col("question_id").isNotNull())
    chosen = accepted.groupBy("question_id").agg(
        F.collect_list("accepted_answer_id").alias("_chosen")
    )
    # An answer that is named as accepted several times counts as often.
    named = F.coalesce(F.size(F.filter("_chosen", lambda a: a == F.col("id"))), F.lit(0))
    times = F.greatest(named, F.lit(1)).cast("bigint")
    weight = (
        F.when(F.col("postTypeId") == QUESTION, ASKED).when(named > 0, ACCEPTED).otherwise(ANSWERED)
    )

    def weighed(some: DataFrame) -> DataFrame:
        return some.join(chosen, "question_id", "left").select(
            "question_id", "user_id", (weight * times).alias("weight"), times.alias("posts")
        )

    if dealt:
        # Apart until ids are gone: the two sides then lie by the same column.
        sides = [weighed(entries.where(F.col("postTypeId") == kind)) for kind in (QUESTION, ANSWER)]
        rows = sides[0].unionByName(sides[1])
    else:
        rows = weighed(entries.repartition("question_id"))
    return rows.groupBy("question_id", "user_id").agg(
        F.sum("weight").alias("weight"), F.sum("posts").alias("posts")
    )


def question_user_weights(posts: DataFrame, accepted: DataFrame) -> DataFrame:
    return participation(posts, accepted).drop("posts")


def _chunks_of_question(rows: DataFrame, chunk: int) -> DataFrame:
    """Number the chunks of a question's users, in order of user id; add how many there are."""
    placed = with_positions(rows.select("question_id", "user_id"), "question_id", [F.col("user_id")])
    chunks = placed.groupBy("question_id").agg(
        (F.floor(F.max("position") / chunk) + 1).cast("int").alias("chunks")
    )
    return placed.join(chunks, "question_id").select(
        "question_id",
        "user_id",
        "chunks",
        F.floor(F.col("position") / chunk).cast("int").alias("chunk"),
    )


def _weight_map(kept: Column | None = None) -> Column:
    entry = F.struct("user_id", "weight")
    return F.map_from_entries(F.collect_list(entry if kept is None else F.when(kept, entry)))


def _cut(lists: DataFrame, chunk: int) -> DataFrame:
    """``(question_id, chunks, chunk, _named)`` from sorted ``_entries`` with a user, one list per question.

    A user that is null has a place in the list, but is not named.
    """
    chunks = F.ceil(F.size("_entries") / chunk).cast("int")
    number = F.posexplode(F.sequence(F.lit(0), chunks - 1)).alias("_at", "chunk")
    part = F.slice("_entries", F.col("chunk") * chunk + 1, F.lit(chunk))
    named = F.filter(part, lambda e: e["user_id"].isNotNull())
    return (
        lists.select("question_id", "_entries", chunks.alias("chunks"), number)
        .select("question_id", "chunks", "chunk", named.alias("_named"))
        .where(F.size("_named") > 0)
    )


def _cut_maps(lists: DataFrame, chunk: int) -> DataFrame:
    """``question_weight_maps`` from sorted ``_entries`` of (user, weight), one list per question."""
    return _cut(lists, chunk).select(
        "question_id", "chunks", "chunk", F.map_from_entries("_named").alias("users")
    )


def question_weight_maps(
    weights: DataFrame, chunk: int = CHUNK, whole: int = CHUNK
) -> DataFrame:
    """The same as maps ``user -> weight`` per question.

    A map holds ``chunk`` users at most, in order of their ids; a question's
    maps are numbered by ``chunk`` out of ``chunks``.

    Weights that lie by question, as those of ``participation``, stay there: the
    users of a question are sorted and cut as one list. Questions of more than
    ``whole`` users are ordered over as many tasks as they need.
    """
    spark = weights.sparkSession
    rows = weights.select("question_id", "user_id", "weight")
    rows = staged_by_key(spark, rows, "map-rows", "question_id", dealt=True)
    crowded = key_sizes(rows, "question_id", "weight").where(F.col("_size") > whole)
    crowded = staged(spark, crowded.select("question_id"), "crowded-questions")
    none = crowded.isEmpty()
    entries = F.sort_array(F.collect_list(F.struct("user_id", "weight")))
    lists = (
        (rows if none else rows.join(crowded, "question_id", "left_anti"))
        .groupBy("question_id")
        .agg(entries.alias("_entries"))
    )
    maps = _cut_maps(lists, chunk)
    if none:
        return maps
    return maps.unionByName(_ordered_weight_maps(rows.join(crowded, "question_id", "left_semi"), chunk))


def _ordered_weight_maps(weights: DataFrame, chunk: int) -> DataFrame:
    """``question_weight_maps`` of questions of any size, by range partitions."""
    numbered = _chunks_of_question(weights, chunk)
    return (
        weights.join(numbered, ["question_id", "user_id"])
        .groupBy("question_id", "chunks", "chunk")
        .agg(_weight_map().alias("users"))
    )


def merge_weight_maps(first: str, second: str) -> Column:
    """Union of two weight maps, weights of shared users added."""
    none = F.lit(0).cast("bigint")
    return F.map_zip_with(
        first, second, lambda _, x, y: F.coalesce(x, none) + F.coalesce(y, none)
    )


def merged_question_weight_maps(
    posts: DataFrame, accepted: DataFrame, chunk: int = CHUNK, whole: int = CHUNK, dealt: bool = False
) -> DataFrame:
    """Weight maps of askers and of answerers, built apart and merged per question.

    The rows of both lie by question, where the users of a question are sorted,
    numbered and cut as one list. Questions of more than ``whole`` rows are
    ordered over as many tasks as they need. ``dealt``: as in ``participation``.
    """
    spark = posts.sparkSession
    sides = [
        participation(posts.where(F.col("postTypeId") == kind), accepted, dealt)
        .drop("posts")
        .withColumn("asked", F.lit(kind == QUESTION))
        for kind in (QUESTION, ANSWER)
    ]
    roles = staged_by_key(spark, sides[0].unionByName(sides[1]), "role-rows", "question_id", dealt=True)
    crowded = key_sizes(roles, "question_id", "weight").where(F.col("_size") > whole)
    crowded = staged(spark, crowded.select("question_id"), "crowded-questions")
    none = crowded.isEmpty()
    entry = F.struct("user_id", "asker", "answerer")
    lists = (
        (roles if none else roles.join(crowded, "question_id", "left_anti"))
        .groupBy("question_id", "user_id")
        .agg(
            F.sum(F.when(F.col("asked"), F.col("weight"))).alias("asker"),
            F.sum(F.when(~F.col("asked"), F.col("weight"))).alias("answerer"),
        )
        .groupBy("question_id")
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"))
    )

    def of(role: str) -> Column:
        some = F.filter("_named", lambda e: e[role].isNotNull())
        return F.map_from_entries(F.transform(some, lambda e: F.struct(e["user_id"], e[role])))

    maps = (
        _cut(lists, chunk)
        .select("question_id", "chunk", of("asker").alias("askers"), of("answerer").alias("answerers"))
        .select("question_id", "chunk", merge_weight_maps("askers", "answerers").alias("users"))
    )
    if none:
        return maps
    return maps.unionByName(_ordered_merged_maps(roles.join(crowded, "question_id", "left_semi"), chunk))


def _ordered_merged_maps(roles: DataFrame, chunk: int) -> DataFrame:
    """``merged_question_weight_maps`` of questions of any size, by range partitions."""
    numbered = _chunks_of_question(roles.select("question_id", "user_id").distinct(), chunk)
    return (
        roles.join(numbered, ["question_id", "user_id"])
        .groupBy("question_id", "chunk")
        .agg(
            _weight_map(F.col("asked")).alias("askers"),
            _weight_map(~F.col("asked")).alias("answerers"),
        )
        .select("question_id", "chunk", merge_weight_maps("askers", "answerers").alias("users"))
    )


def merge_maps_by_key(maps: DataFrame, key: list[str], slot: str, fan: int = FAN) -> DataFrame:
    """``(*key, users)``: any number of weight maps per key as one.

    ``slot`` numbers the maps of a key, a few at most to a number. Maps of one
    slot are merged, then ``fan`` slots at a time, until a key has one: a tree,
    so no task merges more than a few maps of a key, however many it has.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))

    def merged(rows: DataFrame) -> DataFrame:
        union = F.reduce("_maps", none, lambda a, b: merge_weight_maps(a, b))
        return (
            rows.groupBy(*key, slot)
            .agg(F.collect_list("users").alias("_maps"))
            .select(*key, slot, union.alias("users"))
        )

    spark = maps.sparkSession
    while True:
        maps = staged(spark, merged(maps), "merged-maps")
        if maps.where(F.col(slot) > 0).isEmpty():
            return maps.select(*key, "users")
        maps = maps.withColumn(slot, F.floor(F.col(slot) / fan))


def weight_maps_from_posts(
    posts: DataFrame, accepted: DataFrame, chunk: int = CHUNK, fan: int = FAN
) -> DataFrame:
    """``question_weight_maps``, from a map of one entry per post.

    Equal to the maps of summed rows, with the sums made by merging maps. The
    users of a question with more posts than a map may hold are dealt over
    several parts first, so that no map outgrows ``chunk`` by far.
    """
    chosen = accepted.select(
        F.col("accepted_answer_id").alias("id"), "question_id", F.lit(True).alias("_chosen")
    )
    entries = posts.select(
        "id", "postTypeId", F.col("ownerUserId").alias("user_id"), _question_of_post().alias("question_id")
    ).where(F.col("question_id").isNotNull())
    weight = (
        F.when(F.col("postTypeId") == QUESTION, ASKED).when(F.col("_chosen"), ACCEPTED).otherwise(ANSWERED)
    )
    each = entries.join(chosen, ["id", "question_id"], "left").select(
        "question_id", "id", "user_id", weight.cast("bigint").alias("weight")
    )
    sizes = each.groupBy("question_id").agg(F.count("*").alias("_posts"))
    parts = F.ceil(F.col("_posts") / chunk)
    slots = F.ceil(F.col("_posts") / (parts * fan))
    placed = (
        each.join(sizes, "question_id")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("user_id"), F.col("parts")))
        .withColumn("slot", F.pmod(F.xxhash64("id"), slots))
        .select(
            "question_id", "parts", "part", "slot", F.create_map("user_id", "weight").alias("users")
        )
    )
    maps = merge_maps_by_key(placed, ["question_id", "parts", "part"], "slot", fan)
    several = maps.where("parts > 1").select(
        "question_id", F.explode("users").alias("user_id", "weight")
    )
    named = F.transform(
        F.map_entries("users"), lambda e: F.struct(e["key"].alias("user_id"), e["value"].alias("weight"))
    )
    single = maps.where("parts = 1").select("question_id", F.sort_array(named).alias("_entries"))
    cut = _cut_maps(single, chunk)
    return cut.unionByName(question_weight_maps(several.repartition("question_id"), chunk))


def largest_question(weights: DataFrame) -> int:
    """Users of the most crowded question; one number, for choosing a plan."""
    sizes = weights.groupBy("question_id").agg(F.count("*").alias("_size"))
    return sizes.agg(F.max("_size")).first()[0] or 0


def _sum_pairs(pairs: DataFrame, member: str) -> DataFrame:
    mine, other = F.col(f"a.{member}"), F.col(f"b.{member}")
    return (
        pairs.select(
            F.least(mine, other).alias("first"),
            F.greatest(mine, other).alias("second"),
            (F.col("a.weight") + F.col("b.weight")).alias("weight"),
        )
        .groupBy("first", "second")
        .agg(F.sum("weight").alias("weight"))
    )


def pair_weights(
    weights: DataFrame, block: int = BLOCK, largest: int | None = None
) -> DataFrame:
    """``(first, second, weight)``: every unordered pair that shares a question, once.

    A pair's weight is the sum over shared questions of both users' weights.
    Crowded questions are cut into blocks of users. Where the ``largest``
    question is known to fit a block, a plain join does and saves a shuffle.
    """
    rows = weights.select("question_id", "user_id", "weight")
    if largest is not None and largest <= block:
        a, b = rows.alias("a"), rows.alias("b")
        met = (F.col("a.question_id") == F.col("b.question_id")) & (
            F.col("a.user_id") < F.col("b.user_id")
        )
        return _sum_pairs(a.join(b, met), "user_id")
    sizes = key_sizes(rows, "question_id", "weight")
    sized = with_sizes(rows, sizes, "question_id", "user_id", block)
    return pair_weights_sized(sized, block=block)


def pair_weights_sized(
    sized: DataFrame, member: str = "user_id", block: int = BLOCK, with_self: bool = False
) -> DataFrame:
    """``pair_weights`` for rows that already carry the size of crowded questions."""
    cells = self_join_cells(sized, member, block)
    return _sum_pairs(unordered_pairs(cells, "question_id", member, with_self), member)


def both_directions(pairs: DataFrame) -> DataFrame:
    """Turn ``(first, second, ...)`` into rows for either user, without a shuffle."""
    rest = [c for c in pairs.columns if c not in ("first", "second")]

    def side(user: str, neighbor: str) -> Column:
        return F.struct(F.col(user).alias("user_id"), F.col(neighbor).alias("neighbor_id"))

    sides = F.array(side("first", "second"), side("second", "first"))
    return pairs.select(F.inline(sides), *rest)


def user_links(
    weights: DataFrame, block: int = BLOCK, largest: int | None = None
) -> DataFrame:
    """Linked users, in both directions, with the weight of the link.

    The links are symmetric, so pairs are joined and summed once and mirrored
    at the end: half the rows are shuffled.
    """
    return both_directions(pair_weights(weights, block, largest))


def linked_users(weights: DataFrame) -> DataFrame:
    """Users with at least one link, told from the sizes of their questions alone."""
    shared = weights.groupBy("question_id").agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    return weights.join(shared, "question_id", "left_semi").select("user_id").distinct()


def user_links_from_maps(maps: DataFrame, met: int = MET) -> DataFrame:
    """The same links by map functions, from ``question_weight_maps``.

    For each user the rest of the map, every value raised by the user's own
    weight, holds the user's links through that question. Links are symmetric:
    the rest is taken of the greater users, summed once and mirrored at the end.

    Up to ``met`` maps of a question meet where they lie. Where it has more,
    each meets each, every two of them in a task of their own.
    """
    few = (
        maps.where(F.col("chunks") <= met)
        .groupBy("question_id")
        .agg(F.collect_list("users").alias("_maps"))
        .select(F.explode("_maps").alias("mine"), F.col("_maps").alias("theirs"))
    )
    several = maps.where(F.col("chunks") > met)
    counterpart = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    mine = several.select(
        "question_id",
        F.col("chunk").alias("_mine"),
        counterpart.alias("_theirs"),
        F.col("users").alias("mine"),
    )
    theirs = several.select(
        "question_id",
        counterpart.alias("_mine"),
        F.col("chunk").alias("_theirs"),
        F.array("users").alias("theirs"),
    )
    by_twos = mine.join(theirs, ["question_id", "_mine", "_theirs"]).select("mine", "theirs")
    each = few.unionByName(by_twos).select(F.explode("mine").alias("user_id", "own"), "theirs")
    each = each.select("user_id", "own", F.explode("theirs").alias("theirs"))
    others = F.map_filter("theirs", lambda user, _: user > F.col("user_id"))
    raised = F.transform_values(others, lambda _, weight: weight + F.col("own"))
    return both_directions(
        each.select(F.col("user_id").alias("first"), F.explode(raised).alias("second", "weight"))
        .groupBy("first", "second")
        .agg(F.sum("weight").alias("weight"))
    )


def circle_rows(weights: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The weights of requested users, and all weights of the questions they took part in.

    ``(question_id, user_id, own)`` and ``(question_id, neighbor_id, weight)``, both
    written by question. The requested users are written first: Spark knows then
    how few they are, and broadcasts them if so, where the weights would otherwise
    be dealt by user before it can tell.
    """
    spark = weights.sparkSession
    wanted = staged(spark, requests.select("user_id").distinct(), "requested-users")
    asked = weights.join(wanted, "user_id", "left_semi")
    mine = staged_by_key(
        spark,
        asked.select("question_id", "user_id", F.col("weight").alias("own")),
        "circle-requests",
        "question_id",
    )
    others = weights.join(mine.select("question_id").distinct(), "question_id", "left_semi").select(
        "question_id", F.col("user_id").alias("neighbor_id"), "weight"
    )
    return mine, staged_by_key(spark, others, "circle-rows", "question_id", dealt=True)


def circle_meetings(mine: DataFrame, others: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(user_id, neighbor_id, weight)``: a row per shared question, for the two sides of ``circle_rows``."""
    met = blocked_join(mine, others, "question_id", "user_id", "neighbor_id", block)
    return met.where(F.col("user_id") != F.col("neighbor_id")).select(
        "user_id", "neighbor_id", (F.col("own") + F.col("weight")).alias("weight")
    )


def circles(weights: DataFrame, requests: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links of the requested users only: their one-circle networks.

    Only the questions of requested users are looked at, so the work follows
    the request and not the whole network: the rows of the request and of its
    questions are written once by question, and counted and joined as they lie.
    """
    return (
        circle_meetings(*circle_rows(weights, requests), block)
        .groupBy("user_id", "neighbor_id")
        .agg(F.sum("weight").alias("weight"))
    )
