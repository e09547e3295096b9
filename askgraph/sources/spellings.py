"""JSON dumps whose spelling of field names is not known, or differs by row.

A dump is scanned once as variants, i.e. without a schema; each field is looked
up under all its spellings, row by row.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from askgraph import schemas

# Other names that dumps use for a field.
ALIASES: dict[str, dict[str, tuple[str, ...]]] = {
    "users": {"name": ("displayName",)},
    "posts_questions": {"postDate": ("creationDate",)},
    "posts_answers": {"postDate": ("creationDate",)},
}


def _styles(name: str) -> list[str]:
    """camelCase as it is, snake_case, PascalCase and lower case of a name."""
    snake = re.sub("(?<!^)(?=[A-Z])", "_", name).lower()
    return [name, snake, name[0].upper() + name[1:], name.lower()]


def spellings(
    name: str, aliases: Mapping[str, tuple[str, ...]] | None = None
) -> dict[str, list[str]]:
    """Field of raw dump ``name`` -> its spellings, the ones looked up first in front."""
    others = ALIASES.get(name, {}) if aliases is None else aliases
    unknown = set(others) - set(schemas.RAW[name].names)
    if unknown:
        raise ValueError(f"{name} has no fields {sorted(unknown)}")
    found: dict[str, list[str]] = {}
    owner: dict[str, str] = {}
    for field in schemas.RAW[name].names:
        words = [s for word in (field, *others.get(field, ())) for s in _styles(word)]
        found[field] = list(dict.fromkeys(words))
        for spelling in found[field]:
            if owner.setdefault(spelling, field) != field:
                raise ValueError(f"{spelling} would be both {owner[spelling]} and {field}")
    return found


def _variants(spark: SparkSession, folder: str, name: str) -> DataFrame:
    read = spark.read.option("singleVariantColumn", "_row").option("mode", "FAILFAST")
    return read.json(f"{folder.rstrip('/')}/{name}.json")


def _lookup(spelling: str) -> Column:
    return F.variant_get("_row", f"$['{spelling}']", "string")


def read_any_spelling(
    spark: SparkSession,
    folder: str,
    name: str,
    aliases: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """``read_raw`` for a dump of unknown spelling: the same columns, all strings.

    Per row, a field is the first of its spellings that is there and not null;
    a field that is under none of them is null. Rows of one dump may differ.
    Numbers become their text. A line that is not JSON fails the job.
    """
    fields = spellings(name, aliases)
    return _variants(spark, folder, name).select(
        *(F.coalesce(*map(_lookup, keys)).alias(field) for field, keys in fields.items())
    )


def spellings_used(
    spark: SparkSession,
    folder: str,
    name: str,
    aliases: Mapping[str, tuple[str, ...]] | None = None,
) -> DataFrame:
    """``(field, spelling, rows)``: rows with a value under each spelling, from one pass.

    Spellings that no row has are left out.
    """
    fields = spellings(name, aliases)
    pairs = [(field, key) for field, keys in fields.items() for key in keys]
    counts = [
        F.struct(
            F.lit(field).alias("field"),
            F.lit(key).alias("spelling"),
            F.count_if(_lookup(key).isNotNull()).alias("rows"),
        )
        for field, key in pairs
    ]
    counted = _variants(spark, folder, name).agg(F.array(*counts).alias("_all"))
    return counted.select(F.inline("_all")).where(F.col("rows") > 0)
