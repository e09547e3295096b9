"""The registered queries in ANSI SQL, over the same tables, whole."""

from __future__ import annotations

_VIEWS = {
    "users": """
        select cast(c_custkey as varchar) as id, c_name as name, '' as age, '' as creationDate,
               n_name as location, cast(floor(c_acctbal) as int) as reputation,
               cast(coalesce(up, 0) as int) as upVotes, cast(coalesce(down, 0) as int) as downVotes,
               cast(coalesce(seen, 0) as int) as views
        from customer join nation on c_nationkey = n_nationkey
        left join (select user_id, sum(case when event_type = 'purchase' then 1 else 0 end) as up,
                          sum(case when event_type = 'error' then 1 else 0 end) as down,
                          sum(case when event_type = 'view' then 1 else 0 end) as seen
                   from events group by user_id) e on user_id = c_custkey""",
    "answers": """
        select id, 2 as postTypeId, cast(null as varchar) as title, concat('answer ', id) as body,
               postDate, ownerUserId, tags, score, cast(null as varchar) as acceptedAnswerId,
               parentId, 0 as favoriteCount, cast(null as int) as viewCount
        from (select concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) as id,
                     cast(cast(min(l_shipdate) as date) as varchar) as postDate,
                     cast(cast(floor(l_partkey * 3 / 4) as bigint) as varchar) as ownerUserId,
                     concat_ws('|', min(l_returnflag), min(l_linestatus)) as tags,
                     l_linenumber as score, cast(l_orderkey as varchar) as parentId
              from lineitem group by l_orderkey, l_linenumber, l_partkey, l_suppkey) a""",
    "questions": """
        select cast(o_orderkey as varchar) as id, 1 as postTypeId,
               concat('Order ', o_orderkey) as title, concat('question ', o_orderkey) as body,
               cast(cast(o_orderdate as date) as varchar) as postDate,
               cast(o_custkey as varchar) as ownerUserId,
               concat_ws('|', o_orderpriority, o_orderstatus) as tags,
               cast(o_orderkey % 100 as int) as score,
               case when o_orderstatus = 'F' then coalesce(first_id, '') else '' end
                   as acceptedAnswerId,
               cast(null as varchar) as parentId, cast(o_orderkey % 20 as int) as favoriteCount,
               cast(o_orderkey % 1000 as int) as viewCount
        from orders
        left join (select parentId as q, min(id) as first_id from answers group by parentId) f
          on q = cast(o_orderkey as varchar)""",
    "posts": "select * from questions union all select * from answers",
    "accepted": """
        select id as question_id, acceptedAnswerId as accepted_answer_id
        from posts where postTypeId = 1 and acceptedAnswerId <> ''""",
    "entries": """
        select ownerUserId as user_id, id,
               case postTypeId when 1 then id when 2 then parentId end as question_id, postTypeId
        from posts""",
    "weights": """
        select e.question_id, e.user_id,
               cast(sum(case when postTypeId = 1 then 4 when a.question_id is not null then 3
                        else 2 end) as bigint) as weight,
               cast(count(*) as bigint) as posts
        from entries e left join accepted a
          on a.question_id = e.question_id and a.accepted_answer_id = e.id
        where e.question_id is not null group by e.question_id, e.user_id""",
    "requests": "select distinct cast(user_id as varchar) as user_id from events",
    "links": """
        select a.user_id, b.user_id as neighbor_id, cast(sum(a.weight + b.weight) as bigint) as weight
        from weights a join weights b on a.question_id = b.question_id and a.user_id <> b.user_id
        group by a.user_id, b.user_id""",
    "bags": """
        select user_id as neighbor_id, question_id from entries
        where question_id not in (select question_id from accepted)""",
    "listed": """
        select user_id, question_id, neighbor_id, weight
        from links join bags using (neighbor_id)""",
    "heads": """
        select neighbor_id, question_id
        from (select *, row_number() over (partition by neighbor_id order by question_id) as place
              from bags) b where place <= 5""",
    "top5": """
        select user_id, cast(place as int) as rank, question_id, neighbor_id, weight
        from (select *, row_number() over (partition by user_id
                     order by weight desc, question_id, neighbor_id) as place
              from links join heads using (neighbor_id)) r
        where place <= 5""",
}

_ORDER = {name: position for position, name in enumerate(_VIEWS)}
_NEEDS = {
    "questions": ["answers"],
    "posts": ["answers", "questions"],
    "accepted": ["posts"],
    "entries": ["posts"],
    "weights": ["entries", "accepted"],
    "links": ["weights"],
    "bags": ["entries", "accepted"],
    "listed": ["links", "bags"],
    "heads": ["bags"],
    "top5": ["links", "heads"],
}

_SAMPLE = "cast('0x' || substr(md5(concat('42:', id)), 1, 8) as bigint) < 429496730"


def _sql(query: str, *views: str, **changed: str) -> str:
    """The query after the views it needs; ``changed`` views replace those of their name."""
    needed: set[str] = set()
    pending = list(views)
    while pending:
        name = pending.pop()
        if name not in needed:
            needed.add(name)
            pending.extend(_NEEDS.get(name, []))
    if not needed:
        return query
    views_now = _VIEWS | changed
    parts = [f"{n} as materialized ({views_now[n]})" for n in sorted(needed, key=_ORDER.get)]
    return "with " + ",\n".join(parts) + "\n" + query


_FEED = """
    select t.user_id, t.rank, t.weight, t.question_id as post_id, p.title as post_title,
           p.body as post_body, p.postDate as post_post_date, p.ownerUserId as post_owner_user_id,
           p.score as post_score, p.favoriteCount as post_favorite_count,
           p.viewCount as post_view_count, t.neighbor_id as post_connection,
           u.name as user_name, u.location as user_location, u.reputation as user_reputation,
           u.upVotes as user_upVotes, u.downVotes as user_downVotes, u.views as user_views
    from top5 t left join posts p on p.id = t.question_id left join users u on u.id = t.user_id"""

#: Materialized as one more part: read in parts, the joins are planned otherwise and don't end.
_WHOLE_FEED = f", feed as materialized ({_FEED}) select * from feed"

_FEED_JSON = f"""
    select l.user_id,
           concat('{{', concat_ws(',', string_agg(concat('"', f.rank - 1, '":',
             json_object('id', post_id, 'title', post_title, 'body', post_body,
                         'post_date', post_post_date, 'owner_user_id', post_owner_user_id,
                         'score', post_score, 'favorite_count', post_favorite_count,
                         'view_count', post_view_count, 'connection', post_connection)),
             ',' order by f.rank) filter (where f.rank is not null), concat('"user":',
             any_value(json_object('id', l.user_id, 'name', u.name, 'location', u.location,
                         'reputation', u.reputation, 'upVotes', u.upVotes,
                         'downVotes', u.downVotes, 'views', u.views)))), '}}') as feed
    from (select distinct user_id from links) l
    left join ({_FEED}) f on f.user_id = l.user_id
    left join users u on u.id = l.user_id
    group by l.user_id"""

_CHECKSUM = """cast(sum(cast('0x' || substr(md5(concat_ws('|', question_id, neighbor_id, weight)), 1, 8)
                   as bigint)) as bigint)"""

_DOCUMENTS = """
    select concat(d.user_id, '/', cast(coalesce(page, 0) as int)) as _id, d.user_id,
           cast(coalesce(page, 0) as int) as page, cast(coalesce(n, 0) as int) as n,
           coalesce(digest, md5('')) as digest
    from (select distinct user_id from links) d
    left join (select user_id, page, count(*) as n,
                      md5(string_agg(concat_ws(':', question_id, neighbor_id, weight), ','
                          order by weight desc, question_id, neighbor_id)) as digest
               from (select *, (row_number() over (partition by user_id
                            order by weight desc, question_id, neighbor_id) - 1) // 1000 as page
                     from listed) p
               group by user_id, page) g on g.user_id = d.user_id"""

_MAPS = """
    select question_id, cast(chunk as int) as chunk, cast(count(*) as int) as n,
           string_agg(concat_ws(':', user_id, weight), ',' order by user_id) as users
    from (select *, (row_number() over (partition by question_id order by user_id) - 1) // 3 as chunk
          from weights) w group by question_id, chunk"""

_RANKED = """
    select user_id, row_number() over (partition by user_id
                order by weight desc, question_id, neighbor_id) - 1 as position,
           question_id, neighbor_id, weight from listed"""

_CLEAN_POSTS = """
    select id, postTypeId, title, body, postDate,
           case when postTypeId = 1 and cast(id as varchar) not like '%-%'
                     and cast(id as bigint) % 50 = 7 then null else ownerUserId end as ownerUserId,
           replace(tags, '|', ',') as tags, cast(len(string_split(tags, '|')) as int) as n_tags,
           score, acceptedAnswerId, parentId,
           case when postTypeId = 1 and cast(id as bigint) % 3 = 0 then 0 else favoriteCount end
               as favoriteCount, viewCount
    from posts"""
_CLEAN_POSTS = f"select * from ({_CLEAN_POSTS}) c where ownerUserId is not null"

_DIGIT = "substr(md5(id), 1, 1)"
_ACCEPTED_POSTS = f"select * from ({_CLEAN_POSTS}) a where {_DIGIT} > '3'"

_QUARANTINED = f"""
    select id, ownerUserId,
           case {_DIGIT} when '0' then 'score is not a whole number' when '1' then 'body is null'
                when '2' then 'body is null, score is not a whole number'
                else 'favoriteCount is not a whole number' end as broken,
           case {_DIGIT} when '0' then 'n/a' when '2' then null else cast(score as varchar) end as raw_score,
           case when {_DIGIT} in ('1', '2') then null else body end as raw_body
    from ({_CLEAN_POSTS}) q where {_DIGIT} <= '3'"""

# Labels of posts: not null first, numbers named as such.
_RULES = {
    "rows": "true",
    "quarantined": "digit <= '3'",
    "score is not a whole number": "digit in ('0', '2')",
    "body is null": "digit in ('1', '2')",
    "favoriteCount is not a whole number": "digit = '3'",
    **{f"{name} is null": "false" for name in ("id", "postDate", "ownerUserId", "tags")},
    **{f"{name} is not a whole number": "false" for name in ("postTypeId", "viewCount")},
}
_BROKEN_RULES = f"""
    with p as ({{with_views}} select {_DIGIT} as digit from ({_CLEAN_POSTS}) q)
    """ + " union all ".join(
    f"select '{label}' as rule, cast(count(*) filter (where {test}) as bigint) as rows from p"
    for label, test in _RULES.items()
)

_SPELLED = {
    "postTypeId": "post_type_id",
    "postDate": "creation_date",
    "ownerUserId": "owner_user_id",
    "acceptedAnswerId": "accepted_answer_id",
    "favoriteCount": "favorite_count",
    "viewCount": "view_count",
}
_ABSENT = {
    "ownerUserId": "cast(id as bigint) % 50 = 7",
    "favoriteCount": "cast(id as bigint) % 3 = 0",
    "acceptedAnswerId": "acceptedAnswerId = ''",
}
_FIELDS = [*_SPELLED, "id", "title", "body", "tags", "score"]
_SPELLINGS = "select field, spelling, cast(sum(n) as bigint) as rows from (" + " union all ".join(
    f"""select '{field}' as field, '{spelling}' as spelling, count(*) as n from questions
        where {_DIGIT} {half} '8' and not ({_ABSENT.get(field, "false")})"""
    for field in _FIELDS
    for half, spelling in (("<", field), (">=", _SPELLED.get(field, field)))
) + ") s group by field, spelling having sum(n) > 0"

_PARTICIPATION = """select cast(count(*) as bigint) as users,
                  cast(coalesce(sum(case when answers > 5 then 1 else 0 end), 0) as bigint)
                      as active_users,
                  avg(case when answers > 5 then 1 else 0 end) as share
           from users left join (select ownerUserId, count(*) as answers from posts
                                 where postTypeId = 2 group by ownerUserId) a on ownerUserId = id"""

_SAMPLED_ENTRIES = f"{_VIEWS['entries']} where {_SAMPLE}"

_LINKS = "select user_id, neighbor_id, weight from links"

ORACLES: dict[str, str] = {
    "accepted_answers": _sql("select question_id, accepted_answer_id from accepted", "accepted"),
    "interactions": _sql(
        "select user_id, question_id from entries where question_id is not null", "entries"
    ),
    "user_question_bags": _sql(
        """select user_id, cast(chunk as int) as chunk, cast(count(question_id) as int) as n,
                  coalesce(string_agg(question_id, ',' order by question_id), '') as questions
           from (select *, case when question_id is null then 0 else
                        (row_number() over (partition by user_id order by question_id nulls last, id) - 1)
                        // 20 end as chunk
                 from entries) e
           group by user_id, chunk""",
        "entries",
    ),
    "question_user_weights": _sql("select question_id, user_id, weight from weights", "weights"),
    "question_weight_maps": _sql(_MAPS, "weights"),
    "merged_question_weight_maps": _sql(_MAPS, "weights"),
    "user_links": _sql(_LINKS, "links"),
    "user_links_from_maps": _sql(_LINKS, "links"),
    "circle_networks": _sql(
        f"{_LINKS} where user_id in (select user_id from requests)", "links", "requests"
    ),
    "candidates": _sql(
        f"""select user_id, cast(count(*) as bigint) as n, cast(sum(weight) as bigint) as total_weight,
                   {_CHECKSUM} as checksum
            from listed group by user_id""",
        "listed",
    ),
    "recommendations": _sql(_DOCUMENTS, "listed"),
    "stored_recommendations": _sql(_DOCUMENTS, "listed"),
    "feed_top5": _sql("select * from top5", "top5"),
    "feed": _sql(_WHOLE_FEED, "top5", "users"),
    "feed_requested": _sql(
        _WHOLE_FEED,
        "requests",
        "top5",
        "users",
        links=f"{_VIEWS['links'].replace('group by', 'where a.user_id in (select user_id from requests) group by')}",
    ),
    "feed_json": _sql(_FEED_JSON, "top5", "users"),
    "ingest_users": _sql("select * from users", "users"),
    "ingest_tags": """select p_brand as id, p_brand as tagName, cast(count(*) as int) as "count"
                      from part group by p_brand""",
    "ingest_comments": """
        select cast(event_id as varchar) as id, props as text,
               cast(cast(ts as date) as varchar) as creationDate,
               cast(event_id as varchar) as postId, cast(user_id as varchar) as userId
        from events""",
    "ingest_posts": _sql(_CLEAN_POSTS, "posts"),
    "stored_posts": _sql(_CLEAN_POSTS, "posts"),
    "peek_questions": _sql(
        """select id, title, acceptedAnswerId,
                  case when cast(id as bigint) % 3 = 0 then 0 else favoriteCount end as favoriteCount
           from questions order by id limit 20""",
        "questions",
    ),
    "sample_posts": _sql(
        f"select id from posts where {_SAMPLE}",
        "posts",
    ),
    "answer_participation": _sql(_PARTICIPATION, "users", "posts"),
    "answer_participation_sampled": _sql(
        _PARTICIPATION.replace("from posts", f"from (select * from posts where {_SAMPLE}) s"),
        "users",
        "posts",
    ),
    "feed_from_documents": _sql("select * from top5", "top5"),
    "feed_requested_from_documents": _sql(
        "select * from top5 where user_id in (select user_id from requests)", "top5", "requests"
    ),
    "question_weight_maps_merged": _sql(_MAPS, "weights"),
    "feed_top5_crowds": _sql("select * from top5", "top5"),
    "feed_top5_sampled": _sql("select * from top5", "top5", entries=_SAMPLED_ENTRIES),
    "candidates_sampled": _sql("select * from listed", "listed", entries=_SAMPLED_ENTRIES),
    "ranked_sampled": _sql(_RANKED, "listed", entries=_SAMPLED_ENTRIES),
    "ingest_posts_mapped": _sql(_CLEAN_POSTS, "posts"),
    "ingest_posts_spelled": _sql(_CLEAN_POSTS, "posts"),
    "dump_spellings": _sql(_SPELLINGS, "questions"),
    "ingest_posts_accepted": _sql(_ACCEPTED_POSTS, "posts"),
    "quarantined_posts": _sql(_QUARANTINED, "posts"),
    "broken_rules": _BROKEN_RULES.format(with_views=_sql("", "posts")),
}
