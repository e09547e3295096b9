"""The contract of the clean tables, observed instead of enforced.

The cleaning of ``operators.ingest`` fails at the first row that breaks a rule.
Here one pass over the dump sorts rows into accepted and quarantined ones and
counts how many rows break each rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from askgraph import schemas
from askgraph.functions import split_tags, whole_number

TABLE_OF = {
    "users": "users",
    "posts_questions": "posts",
    "posts_answers": "posts",
    "tags": "tags",
    "comments": "comments",
}
# Numbers that may be null in a dump: they become 0.
OPTIONAL = frozenset({"favoriteCount"})


def rules(name: str) -> dict[str, Column]:
    """What a row of raw dump ``name`` can break: the rule's label and its test."""
    there = set(schemas.RAW[name].names)
    found = {}
    for field in schemas.CLEAN[TABLE_OF[name]]:
        value = F.col(field.name)
        if field.name not in there:
            continue
        if isinstance(field.dataType, T.IntegerType):
            bad = whole_number(value).isNull()
            if field.name in OPTIONAL:
                bad = bad & value.isNotNull()
            found[f"{field.name} is not a whole number"] = bad
        elif not field.nullable:
            found[f"{field.name} is null"] = value.isNull()
    return found


def _value(name: str, field: T.StructField) -> Column:
    if field.name not in schemas.RAW[name].names:
        return F.lit(None).cast(field.dataType)
    value = F.col(field.name)
    if isinstance(field.dataType, T.IntegerType):
        number = whole_number(value)
        return F.when(value.isNull(), F.lit(0)).otherwise(number) if field.name in OPTIONAL else number
    if isinstance(field.dataType, T.ArrayType):
        return split_tags(field.name)
    if field.name == "acceptedAnswerId":
        return F.coalesce(value, F.lit(""))
    return value


def marked(raw: DataFrame, name: str) -> DataFrame:
    """Clean columns without failures, ``broken`` (labels) and ``record``.

    ``record`` is the raw row as JSON where it breaks a rule, else null; values
    that don't parse are null in their clean column. Posts without an owner are
    dropped, as in the strict cleaning: they break no rule.
    """
    if TABLE_OF[name] == "posts":
        raw = raw.where(F.col("ownerUserId").isNotNull())
    labels = F.array_compact(F.array(*(F.when(bad, F.lit(label)) for label, bad in rules(name).items())))
    record = F.to_json(F.struct(*schemas.RAW[name].names))
    return raw.select(
        *(_value(name, f).alias(f.name) for f in schemas.CLEAN[TABLE_OF[name]]),
        labels.alias("broken"),
        F.when(F.size(labels) > 0, record).alias("record"),
    )


def sort_out(dumps: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Write the dumps of one clean table to ``path``, accepted rows and others apart.

    ``dumps`` names the raw tables, e.g. posts_questions and posts_answers. Each
    is scanned once: the folders ``quarantined=0`` and ``quarantined=1`` are
    written in the pass that counts. Returns the counts: ``rows``,
    ``quarantined`` and rows per rule; a row that breaks several rules counts
    for each. Counting is part of the writing tasks, behind no shuffle, so a
    task that is tried again counts once. ``sources.tables.read_table`` reads the
    accepted rows, ``quarantine`` the others.
    """
    parts = [marked(raw, name) for name, raw in dumps.items()]
    labels = dict.fromkeys(label for name in dumps for label in rules(name))
    rows = reduce(DataFrame.unionByName, parts)
    bad = F.size("broken") > 0
    seen = Observation()
    counted = rows.observe(
        seen,
        F.count("*").alias("rows"),
        F.count_if(bad).alias("quarantined"),
        *(F.count_if(F.array_contains("broken", label)).alias(label) for label in labels),
    )
    flag = bad.cast("int").alias("quarantined")
    counted.select("*", flag).write.partitionBy("quarantined").parquet(path)
    return {key: int(n) for key, n in seen.get.items()}


def _stored(spark: SparkSession, path: str, table: str) -> DataFrame:
    fields = [T.StructField(f.name, f.dataType) for f in schemas.CLEAN[table]]
    kept = "broken array<string>, record string, quarantined int"
    schema = T.StructType(fields + T._parse_datatype_string(kept).fields)
    return spark.read.schema(schema).parquet(path)


def accepted(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The accepted rows of a table written by ``sort_out``, in the clean layout."""
    return _stored(spark, path, table).where("quarantined = 0").select(schemas.CLEAN[table].names)


def quarantine(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The other rows: clean columns as far as they parse, ``broken`` and ``record``."""
    return _stored(spark, path, table).where("quarantined = 1").drop("quarantined")
