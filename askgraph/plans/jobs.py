"""The two batch jobs: dumps to clean tables, clean tables to feeds.

Run with spark-submit::

    spark-submit --py-files askgraph.zip run_job.py ingest  <dump folder> <table folder>
    spark-submit --py-files askgraph.zip run_job.py analyse <table folder> <result folder>

``ingest`` takes ``--any-spelling`` for dumps of unknown field names,
``--fields names.json`` for known ones, e.g. {"users": {"name": "displayName"}}, and
``--quarantine`` to set rows that break the contract aside. ``analyse`` takes
``--fraction``, ``--exclude-own``, ``--no-documents`` and ``--document-format``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from askgraph.operators import feed as feeds
from askgraph.operators import contract, ingest, network, recommend, reports
from askgraph.session import get_session, removing_staged, staged
from askgraph.sources.spellings import read_any_spelling
from askgraph.sources.tables import read_raw, read_table, write_documents, write_table


def run_ingest(
    spark: SparkSession,
    dumps: str,
    tables: str,
    fields: Mapping[str, Mapping[str, str]] | None = None,
    any_spelling: bool = False,
    quarantine: bool = False,
) -> dict[str, dict[str, int]]:
    """Clean the five JSON dumps into four Parquet tables.

    ``fields`` says per dump what it calls fields that it names differently;
    with ``any_spelling`` that is found row by row. A row that breaks the contract
    fails the job, unless there is a ``quarantine``: then tables hold such rows
    in a folder of their own and the counts per rule are returned. Tables of
    earlier runs are replaced without a quarantine and must not exist with one.
    """
    fields = fields or {}
    if any_spelling and fields:
        raise ValueError("either the names of fields are given or any spelling is read")

    def raw(name: str):
        if any_spelling:
            return read_any_spelling(spark, dumps, name)
        return read_raw(spark, dumps, name, dict(fields.get(name, {})))

    if quarantine:
        kinds: dict[str, list[str]] = {}
        for name, table in contract.TABLE_OF.items():
            kinds.setdefault(table, []).append(name)
        return {
            table: contract.sort_out({n: raw(n) for n in names}, f"{tables.rstrip('/')}/{table}")
            for table, names in kinds.items()
        }
    write_table(ingest.clean_users(raw("users")), tables, "users")
    posts = ingest.clean_posts(raw("posts_questions"), raw("posts_answers"))
    write_table(posts, tables, "posts")
    write_table(ingest.clean_tags(raw("tags")), tables, "tags")
    write_table(ingest.clean_comments(raw("comments")), tables, "comments")
    return {}


def run_analysis(
    spark: SparkSession,
    tables: str,
    results: str,
    fraction: float = 1.0,
    documents: bool = True,
    document_format: str = "json",
    exclude_own: bool = False,
) -> None:
    """Write weights, links, recommendation documents and feeds.

    Each step goes on from the table the last one wrote. With a ``fraction``
    below 1 users, weights and links come from a sample of the posts; whether a
    question is closed is always looked up in all of them. ``exclude_own``
    leaves a user's own questions out of documents and feeds; the best five are
    then the first of the documents. What the steps stage is removed at the end.
    """
    with removing_staged(spark):
        _analyse(spark, tables, results, fraction, documents, document_format, exclude_own)


def _analyse(
    spark: SparkSession,
    tables: str,
    results: str,
    fraction: float,
    documents: bool,
    document_format: str,
    exclude_own: bool,
) -> None:
    users, posts = read_table(spark, tables, "users"), read_table(spark, tables, "posts")
    write_table(network.accepted_answers(posts), results, "accepted")
    accepted = read_table(spark, results, "accepted")
    used = posts if fraction >= 1.0 else reports.sample_by_id(posts, fraction)

    write_table(network.participation(used, accepted), results, "weights")
    weights = read_table(spark, results, "weights")
    largest = network.largest_question(weights)

    if documents or exclude_own:
        write_table(network.user_links(weights, largest=largest), results, "links")
        links = read_table(spark, results, "links")
        bags = recommend.open_bags(weights, accepted)
        own = weights if exclude_own else None
        found = recommend.recommendations(links, bags, own=own)
        if exclude_own:
            found = staged(spark, found, "documents")
    if documents:
        write_documents(
            found,
            document_format,
            mode="overwrite",
            path=f"{results.rstrip('/')}/recommendations",
        )

    if exclude_own:
        top = feeds.top_of_documents(found)
    else:
        top = recommend.top_candidates(weights, accepted, largest=largest)
    write_table(top, results, "top")
    rows = feeds.feed(
        read_table(spark, results, "top"), posts, users, network.linked_users(weights)
    )
    write_table(feeds.feed_json(rows), results, "feeds")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="askgraph")
    parser.add_argument("job", choices=["ingest", "analyse"])
    parser.add_argument("source")
    parser.add_argument("target")
    parser.add_argument("--fraction", type=float, default=1.0)
    parser.add_argument("--no-documents", action="store_true")
    parser.add_argument("--document-format", default="json")
    parser.add_argument("--exclude-own", action="store_true")
    parser.add_argument("--fields", help="JSON file: dump -> field -> its name there")
    parser.add_argument("--any-spelling", action="store_true")
    parser.add_argument("--quarantine", action="store_true")
    options = parser.parse_args(arguments)
    spark = get_session()
    if options.job == "ingest":
        fields = None
        if options.fields:
            with open(options.fields, encoding="utf-8") as file:
                fields = json.load(file)
        counts = run_ingest(
            spark, options.source, options.target, fields, options.any_spelling, options.quarantine
        )
        if counts:
            print(json.dumps(counts))
    else:
        run_analysis(
            spark,
            options.source,
            options.target,
            options.fraction,
            not options.no_documents,
            options.document_format,
            options.exclude_own,
        )
