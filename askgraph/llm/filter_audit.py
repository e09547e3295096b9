"""How document filters interact: what each removes in every order of application.

Each text gets a mask of the filters it fails. Failing the duplicate filter
takes the least id among equal texts. To keep most texts from being shuffled
for that, counting Bloom sketches go first: every task counts hash positions of
its rows, sketches of a block of hashes are added up, and a text with a position
counted once has no equal. Only the rest, the possible repeats, are shuffled with
their full texts for exact least ids. Rows are then summed to counts per part,
mask and label, and all orders are worked out from those counts.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import WORD, staged

FILTERS = "ABCDE"
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, SIGNS = 50, 65, 5, "[#$%&*|]"
#: Hashes of possible repeats that may be broadcast, of 16 bytes each; more are joined by a shuffle.
BROADCAST_HASHES = 2_000_000
#: Rows whose hashes share a sketch, counters of a sketch, counters per hash.
BLOCK_ROWS, COUNTERS, HASHES = 4096, 1 << 16, 3

SQL = """
with texts as materialized (
    select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
words as materialized (
    select *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
           min(doc_id) over (partition by text) as least from texts),
marks as (
    select doc_id, part,
           case when len(words) < 50 then 1 else 0 end as a,
           case when 100 * len(list_distinct(words)) < 65 * len(words) then 1 else 0 end as b,
           case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text)
                then 1 else 0 end as c,
           case when regexp_matches(text, '[#$%&*|]') then 1 else 0 end as d,
           case when doc_id > least then 1 else 0 end as e
    from words),
known as (
    select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
masks as materialized (
    select part, a + 2 * b + 4 * c + 8 * d + 16 * e as mask, a + b + c + d + e as fails, count(*) as n,
           count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from marks left join known using (doc_id) group by all),
letters as (select unnest([1, 2, 3, 4, 5]) as l),
orders as (
    select substr('ABCDE', p.l, 1) || substr('ABCDE', q.l, 1) || substr('ABCDE', r.l, 1)
           || substr('ABCDE', s.l, 1) || substr('ABCDE', t.l, 1) as filter_order
    from letters p, letters q, letters r, letters s, letters t
    where p.l not in (q.l, r.l, s.l, t.l) and q.l not in (r.l, s.l, t.l) and r.l not in (s.l, t.l)
          and s.l <> t.l),
steps as (
    select filter_order, l as step, cast(1 << (ascii(substr(filter_order, l, 1)) - 65) as int) as bit,
           coalesce((select sum(1 << (ascii(substr(filter_order, x.l, 1)) - 65))
                     from letters x where x.l < y.l), 0) as earlier
    from orders, letters y),
hits as (
    select part, filter_order, step, n, good, toxic, fails, mask,
           mask & bit > 0 as own, mask & cast(earlier as int) > 0 as gone, bit
    from masks, steps)
select part, filter_order, cast(step as int) as step,
       cast(coalesce(sum(n) filter (not own and not gone), 0) as bigint) as kept,
       cast(coalesce(sum(n) filter (own and not gone), 0) as bigint) as removed,
       cast(coalesce(sum(n) filter (own and gone), 0) as bigint) as redundant,
       cast(coalesce(sum(n) filter (mask = bit), 0) as bigint) as unique_fails,
       cast(coalesce(sum(good) filter (own and not gone), 0) as bigint) as good_lost,
       cast(coalesce(sum(toxic) filter (own and not gone), 0) as bigint) as toxic_lost,
       cast(coalesce(sum(n * 120 // greatest(fails, 1)) filter (own), 0) as bigint) as shapley
from hits group by part, filter_order, step
"""


def text_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails, A the lowest."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    failed = (
        n < MIN_WORDS,
        distinct * 100 < n * DISTINCT_PERCENT,
        F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * CAPITAL_PERCENT,
        F.regexp_like(text, F.lit(SIGNS)),
    )
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)]
    return sum(bits[1:], bits[0])


def _positions(h2: np.ndarray) -> np.ndarray:
    """The counters of a hash, a column for each: disjoint bits of its second half."""
    bits = COUNTERS.bit_length() - 1
    wide = h2.astype("i8").view("u8")
    return np.stack([(wide >> np.uint64(bits * i)) & np.uint64(COUNTERS - 1) for i in range(HASHES)], 1)


_SKETCH = "block long, positions array<int>, counts array<int>"


def _local_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sketches of a task's rows: the counters in use, counted up to 2, per block and batch."""
    for batch in batches:
        blocks, h2 = batch["block"], batch["h2"]
        order = np.argsort(blocks.to_numpy(), kind="stable")
        blocks, h2 = blocks.to_numpy()[order], h2.to_numpy()[order]
        starts = np.flatnonzero(np.diff(blocks, prepend=blocks[:1] - 1))
        out = []
        for a, b in zip(starts, [*starts[1:], len(blocks)], strict=True):
            # A row counts at its different positions once each.
            each = np.sort(_positions(h2[a:b]), 1)
            new = np.ones(each.shape, bool)
            new[:, 1:] = each[:, 1:] != each[:, :-1]
            used, counts = np.unique(each[new], return_counts=True)
            out.append((int(blocks[a]), used.astype("i4"), np.minimum(counts, 2).astype("i4")))
        kinds = (pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)],
            ["block", "positions", "counts"],
        )


def _merged_sketch(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.bincount(np.concatenate(rows["positions"].tolist()), np.concatenate(rows["counts"].tolist()))
    repeated = np.flatnonzero(total >= 2).astype("i4")
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "repeated": [repeated]})


def _possible(rows: pd.DataFrame, sketch: pd.DataFrame) -> pd.DataFrame:
    """Of the rows of a block those with all counters at 2 or more."""
    if rows.empty or sketch.empty:
        return rows[["h1", "h2"]].iloc[:0]
    repeated = np.zeros(COUNTERS, bool)
    repeated[np.asarray(sketch["repeated"].iloc[0], "i8")] = True
    keep = repeated[_positions(rows["h2"].to_numpy()).astype("i8")].all(1)
    return rows.loc[keep, ["h1", "h2"]]


def possible_repeats(hashed: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Hashes ``(h1, h2)`` that more than one row may have, each once.

    ``hashed`` holds a row per text. No hash of two rows is missing; of a hash
    of one row few are in, as chance has it. Rows go to blocks by ``h1``, and a
    block has a sketch of its own, so sketches keep their size and sharpness
    however many rows there are. A task sends the counters that it used.
    """
    blocks = max(1, math.ceil(hashed.count() / block_rows))
    placed = hashed.select(F.pmod("h1", F.lit(blocks)).alias("block"), "h1", "h2")
    sketches = (
        placed.select("block", "h2")
        .mapInArrow(_local_sketches, _SKETCH)
        .groupBy("block")
        .applyInPandas(_merged_sketch, "block long, repeated array<int>")
        .where(F.size("repeated") > 0)
    )
    # Equal hashes get equal answers, so each is asked once and a block has no hot key.
    asked = placed.dropDuplicates(["block", "h1", "h2"])
    return (
        asked.groupBy("block")
        .cogroup(sketches.groupBy("block"))
        .applyInPandas(_possible, "h1 long, h2 long")
    )


def _least_ids(suspects: DataFrame) -> DataFrame:
    """``(h1, h2, text, least)``: the least id of each text; partial results come before the shuffle."""
    return suspects.groupBy("text").agg(
        F.first("h1").alias("h1"), F.first("h2").alias("h2"), F.min("doc_id").alias("least")
    )


def mask_counts(
    docs: DataFrame,
    labels: DataFrame,
    block_rows: int = BLOCK_ROWS,
    hashes: tuple[Column, Column] | None = None,
) -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents by source and filters failed.

    Bits 0 to 4 of ``mask`` are filters A to E. ``good`` and ``toxic`` count
    documents with a label quality or toxic of 1; of several labels of a
    document the highest counts. A null text counts as empty, a null source as
    the empty part. A row without an id has no smaller one and is none. Equal
    ids with equal texts are no smaller than each other.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    h1, h2 = hashes or (F.xxhash64("text"), F.xxhash64(F.lit("second"), "text"))
    flagged = rows.select("doc_id", "part", text_mask(F.col("text")).alias("mask"), h1.alias("h1"), h2.alias("h2"))
    flagged = staged(spark, flagged, "flags")
    suspected = staged(spark, possible_repeats(flagged, block_rows), "suspects")

    if suspected.count() <= BROADCAST_HASHES:
        suspected = F.broadcast(suspected)
    texts = rows.select("*", h1.alias("h1"), h2.alias("h2"))
    least = _least_ids(texts.join(suspected, ["h1", "h2"], "left_semi"))
    by_hash = least.groupBy("h1", "h2").agg(F.count("*").alias("texts"), F.min("least").alias("least"))
    shared = staged(spark, by_hash, "least")

    known = labels.groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    named = flagged.where("doc_id is not null").join(known, "doc_id", "left")
    labelled = named.unionByName(flagged.where("doc_id is null"), allowMissingColumns=True)
    # Rows of a text are summed before they meet its least id, so copies make no hot key. The
    # first sum counts rows of one id; the second keeps how many have the least of the ids.
    group = ["part", "mask", "good", "toxic", "h1", "h2"]
    summed = (
        labelled.groupBy(*group, "doc_id")
        .agg(F.count("*").alias("rows"))
        .groupBy(*group)
        .agg(
            F.sum("rows").alias("n"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("rows"))).alias("unnamed"),
            F.min("doc_id").alias("first"),
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "rows"))).alias("at_first"),
        )
    )
    one_text = shared.where("texts = 1").drop("texts")
    several = shared.where("texts > 1").select("h1", "h2")
    placed = summed.join(several, ["h1", "h2"], "left_anti").join(one_text, ["h1", "h2"], "left")
    first = F.coalesce(F.col("first") == F.col("least"), F.lit(False))
    original = (
        F.when(F.col("least").isNull(), F.col("n"))
        .when(first, F.coalesce("unnamed", F.lit(0)) + F.col("at_first")["rows"])
        .otherwise(F.coalesce("unnamed", F.lit(0)))
    )
    counts = placed.select("part", "mask", "good", "toxic", original.alias("_kept"), "n").select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("mask"), F.col("_kept").alias("n")),
                F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("_kept")).alias("n")),
            )
        ),
    )
    if not several.isEmpty():
        # Different texts of equal hashes: their rows are compared by full text.
        own = texts.join(several, ["h1", "h2"], "left_semi")
        apart = (
            own.select("doc_id", "part", "text", text_mask(F.col("text")).alias("mask"))
            .join(_least_ids(own).select("text", "least"), "text")
            .join(known, "doc_id", "left")
        )
        copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))
        mask = F.when(copy, F.col("mask") + 16).otherwise(F.col("mask"))
        counts = counts.unionByName(
            apart.select("part", "good", "toxic", mask.alias("mask"), F.lit(1).cast("long").alias("n"))
        )
    return counts.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _steps() -> Column:
    """All steps of all orders: the filter's bit and those of the filters before it."""
    letters = [
        F.struct(
            F.lit("".join(order)).alias("filter_order"),
            F.lit(step + 1).alias("step"),
            F.lit(1 << FILTERS.index(order[step])).alias("bit"),
            F.lit(sum(1 << FILTERS.index(x) for x in order[:step])).alias("earlier"),
        )
        for order in itertools.permutations(FILTERS)
        for step in range(len(FILTERS))
    ]
    return F.array(*letters)


def filter_audit(docs: DataFrame, labels: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per part, order of the filters and step, with what happens there.

    Columns: part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley. See ``mask_counts`` for nulls and ties; an
    empty table gives no rows, further columns are ignored, whatever their
    names. A part's counts fit 32 masks, from which its 600 rows are summed.
    """
    counts = mask_counts(docs, labels, block_rows)
    own = F.col("mask").bitwiseAND(F.col("bit")) > 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) > 0

    def total(value: Column, when: Column, name: str) -> Column:
        return F.sum(F.when(when, value).otherwise(F.lit(0))).cast("long").alias(name)

    n = F.col("n")
    orders = math.factorial(len(FILTERS))
    first_in = F.expr(f"n * {orders} div greatest(bit_count(mask), 1)")
    by_mask = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    return (
        by_mask.select("part", "masks", F.inline(_steps()))
        .select("part", "filter_order", "step", "bit", "earlier", F.inline("masks"))
        .groupBy("part", "filter_order", "step")
        .agg(
            total(n, ~own & ~gone, "kept"),
            total(n, own & ~gone, "removed"),
            total(n, own & gone, "redundant"),
            total(n, F.col("mask") == F.col("bit"), "unique_fails"),
            total(F.col("good"), own & ~gone, "good_lost"),
            total(F.col("toxic"), own & ~gone, "toxic_lost"),
            total(first_in, own, "shapley"),
        )
    )
