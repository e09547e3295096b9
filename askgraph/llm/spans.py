"""Places of pattern matches in texts, with Spark's own functions.

Matches of a pattern and the text between them come from two built-in regular
expression functions; their lengths add up to code-point positions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters before and after a match that come with it.
CONTEXT = 40
_SPAN = "struct<start:bigint,stop:bigint,value:string,before:string,after:string>"


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern, leftmost and non-overlapping: array<struct> as _SPAN."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    numbered = F.transform(
        whole,
        lambda value, i: F.struct(
            F.length(F.get(gaps, i)).cast("long").alias("gap"),
            value.alias("value"),
            F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
            F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    placed = F.aggregate(
        numbered,
        F.struct(
            F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("spans")
        ),
        lambda done, m: F.struct(
            (done["at"] + m["gap"] + F.length(m["value"])).alias("at"),
            F.array_append(
                done["spans"],
                F.struct(
                    (done["at"] + m["gap"]).alias("start"),
                    (done["at"] + m["gap"] + F.length(m["value"])).alias("stop"),
                    m["value"].alias("value"),
                    m["before"].alias("before"),
                    m["after"].alias("after"),
                ),
            ).alias("spans"),
        ),
        lambda done: done["spans"],
    )
    return F.when(text.rlike(pattern), placed).otherwise(F.array().cast(f"array<{_SPAN}>"))


def as_kind(spans: Column, kind: str, order: int, keep: Callable | None = None) -> Column:
    """Spans that pass ``keep`` as struct<start, rank, stop, kind>, which sorts as reported."""
    if keep is not None:
        spans = F.filter(spans, keep)
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("rank"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
        ),
    )


def listed(spans: Column) -> Column:
    """kind:start:stop of spans by start, then rank, comma-joined."""
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
        ),
        ",",
    )


def together(parts: Sequence[Column]) -> Column:
    return F.concat(*parts)


def masked(text: Column, spans: Column, mark: str) -> Column:
    """The text with every stretch that spans cover replaced by ``mark``."""
    init = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        gap = s["start"] - done["at"]
        piece = F.when(
            gap >= 0, F.concat(F.substring(text, done["at"] + 1, gap), F.lit(mark))
        ).otherwise(F.lit(""))
        return F.struct(
            F.greatest(done["at"], s["stop"]).alias("at"),
            F.array_append(done["parts"], piece).alias("parts"),
        )

    def finish(done: Column) -> Column:
        return F.concat(
            F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))
        )

    return F.aggregate(F.array_sort(spans), init, step, finish)
