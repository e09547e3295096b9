"""Cleaning and sampling expressions, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_number(value: Column) -> Column:
    """A whole-number string as int, null for anything else.

    The digits test keeps blanks out, which a plain cast would trim.
    """
    return F.when(value.rlike("^[+-]?[0-9]+$"), value.try_cast("int"))


def strict_int(name: str) -> Column:
    """Parse a whole-number string; anything else, null included, fails the job.

    It does not lean on the session's ANSI setting, so a lenient session is strict too.
    """
    value = F.col(name)
    parsed = whole_number(value)
    complaint = F.concat(
        F.lit(f"{name}: not a 32-bit whole number: "), F.coalesce(value, F.lit("null"))
    )
    return F.coalesce(parsed, F.raise_error(complaint).cast("int"), F.lit(0))


def int_or_zero(name: str) -> Column:
    """Null becomes 0, everything else must parse."""
    return F.when(F.col(name).isNull(), F.lit(0)).otherwise(strict_int(name))


def required(value: Column, label: str, dtype: T.DataType) -> Column:
    """``value``, declared not null; a null met at run time fails the job.

    The last branch is never taken: it is there so that the planner marks the
    column as not null.
    """
    if isinstance(dtype, T.ArrayType):
        never = F.array().cast(dtype)
    else:
        never = F.lit("").cast(dtype) if isinstance(dtype, T.StringType) else F.lit(0).cast(dtype)
    return F.coalesce(value, F.raise_error(F.lit(f"{label} is null")).cast(dtype), never)


def split_tags(name: str) -> Column:
    """Cut ``a|b|`` into ``[a, b]``: literal bars, empty parts at the end dropped."""
    value = F.col(name)
    parts = F.split(F.regexp_replace(value, "[|]+$", ""), "[|]")
    nothing = F.array().cast(T.ArrayType(T.StringType(), False))
    return F.when(value.rlike("^[|]+$"), nothing).otherwise(parts)


def in_hash_sample(name: str, fraction: float, seed: int = 42) -> Column:
    """Repeatable sample test: the same ids are in it on every run and engine.

    The first 32 bits of a digest are compared with that share of their range.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError(f"a fraction is between 0 and 1, not {fraction}")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(name)))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return number < int(round(fraction * 2**32))
