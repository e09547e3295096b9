"""Packing of documents into fixed-size sequences: dominance reduction, then best fit.

Documents are tokenized where they lie and cut into pieces of at most the
sequence size. What packing needs to know of the corpus is how many pieces
there are of each length: a table of at most ``capacity`` rows however large the
input. On that table

1. dominance fixes sets that no other choice can beat: a length that nothing
   fits beside goes alone; a length goes with its exact complement; a length
   beside which only one more piece fits goes with the largest that fits;
2. the rest is packed best fit decreasing, each piece into the fullest sequence
   that still holds it. Equal lengths and equally full sequences are handled
   together, so the work depends on the number of lengths, not of pieces.

The plan says which ranks of each length go where. Pieces then learn their rank
among those of their length from counts per bucket, and look their place up.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from askgraph.llm.common import staged, whole_ids
from askgraph.llm.tokens import default_path, tokenizer

CAPACITY = 4096
END_ID = 1
#: Pieces of one length that share a bucket, about; a length may hold most pieces.
BUCKET_ROWS = 50_000

Run = tuple[int, int, int, int, int]  # length, first rank, count, first sequence, offset


def _encoder(path: str, capacity: int, end_id: int, with_ids: bool, width: int) -> Callable:
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of = tokenizer(path).ids
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.append(ids_of(text or ""), np.uint32(end_id)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    part = ids[start : start + capacity]
                    data = part.tobytes()
                    row = (doc_id, number, start, len(part), zlib.crc32(data))
                    rows.append((*row, part.astype(f"<u{width}").tobytes()) if with_ids else row)
            columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
            out = pd.DataFrame(rows, columns=columns + ["ids"] * with_ids)
            out["doc_id"] = whole_ids(out["doc_id"])
            yield out

    return encode


def pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    width: int = 4,
) -> DataFrame:
    """Documents as token pieces: doc_id, piece, start, length, ids_crc32 [, ids].

    Only documents of more than ``capacity`` ids are cut. ``end_id`` closes each
    document, so an empty or null text is a piece of one id. ``ids`` holds
    unsigned little-endian numbers of ``width`` bytes; the checksum is always of
    32-bit ones.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(
        F.col(id_col).cast("long").cast("string").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInPandas(
        _encoder(path or default_path(), capacity, end_id, with_ids, width),
        schema + (", ids binary" if with_ids else ""),
    )


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Run], dict, int]:
    """Fix dominating sets; returns their runs, the counts left and the sequences used."""
    left, used, runs, sequences = dict(counts), dict.fromkeys(counts, 0), [], 0

    def place(sets: int, *lengths: int) -> None:
        nonlocal sequences
        offset = 0
        for length in lengths:
            runs.append((length, used[length], sets, sequences, offset))
            used[length] += sets
            left[length] -= sets
            offset += length
        sequences += sets

    def smallest(n: int, but: int) -> list[int]:
        """The n smallest pieces left when one of length ``but`` is taken out."""
        found: list[int] = []
        for length in sorted(k for k, v in left.items() if v):
            found += [length] * min(n, left[length] - (length == but))
            if len(found) >= n:
                break
        return found[:n]

    for length in sorted(counts, reverse=True):
        if not left[length]:
            continue
        rest = capacity - length
        partner = left.get(rest, 0) if rest != length else left[length] // 2
        if rest and partner:
            sets = min(partner, left[length])
            place(sets, length, rest)
        while left[length]:
            two = smallest(2, length)
            if not two or two[0] > rest:
                place(left[length], length)
            elif len(two) == 1 or sum(two) > rest:
                fits = max(k for k, v in left.items() if v - (k == length) > 0 and k <= rest)
                sets = left[length] // 2 if fits == length else min(left[length], left[fits])
                place(sets, length, fits)
            else:
                break
    return runs, {k: v for k, v in left.items() if v}, sequences


def best_fit(
    counts: dict[int, int], used: dict[int, int], sequences: int, capacity: int
) -> tuple[list[Run], int]:
    """Best fit decreasing on counts; ``used`` ranks of each length are taken already."""
    runs: list[Run] = []
    free: dict[int, list[tuple[int, int]]] = {}  # room left -> (first sequence, count)
    for length in sorted(counts, reverse=True):
        rank, open_ones = used.get(length, 0), counts[length]
        while open_ones:
            room = min((r for r, some in free.items() if some and r >= length), default=None)
            if room is None:
                first, count, room = sequences, open_ones // max(1, capacity // length), capacity
                count = max(1, count)
                sequences += count
            else:
                first, count = free[room].pop()
            take = min(count, open_ones)
            if take < count:
                free.setdefault(room, []).append((first + take, count - take))
            runs.append((length, rank, take, first, capacity - room))
            if room > length:
                free.setdefault(room - length, []).append((first, take))
            rank += take
            open_ones -= take
    return runs, sequences


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Run], int]:
    """Where the pieces of each length go, and the number of sequences."""
    runs, left, sequences = reduce_by_dominance(counts, capacity)
    used = {k: n - left.get(k, 0) for k, n in counts.items()}
    more, sequences = best_fit(left, used, sequences, capacity)
    return runs + more, sequences


def _placer(runs: list[Run]) -> Callable:
    by_length = {}
    for length in {run[0] for run in runs}:
        mine = sorted(run[1:] for run in runs if run[0] == length)
        by_length[length] = np.array(mine, dtype="i8").T

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch.reset_index(drop=True)
            sequence, offset = (np.zeros(len(out), "i8") for _ in range(2))
            for length, rows in out.groupby("length").indices.items():
                ranks, _, sequences, offsets = by_length[length]
                rank = out["rank"].to_numpy()[rows]
                run = np.searchsorted(ranks, rank, "right") - 1
                sequence[rows] = sequences[run] + rank - ranks[run]
                offset[rows] = offsets[run]
            out["sequence_id"], out["offset"] = sequence, offset
            out["doc_id"] = whole_ids(out["doc_id"])
            yield out.drop(columns="rank")

    return place


def with_rank(rows: DataFrame, total: int, order: list[str]) -> DataFrame:
    """Add ``rank``: the place of each row among those of its length, from 0.

    Lengths are cut into buckets; a rank is the rank in the bucket plus the
    rows of the buckets before it, which are counts per length and bucket.
    """
    buckets = max(8, -(-total // BUCKET_ROWS))
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        dealt.groupBy("length", "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    return (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(starts, ["length", "_bucket"])
        .withColumn("rank", F.col("_start") + F.col("_place"))
        .drop("_start", "_place", "_bucket")
    )


def pack_best_fit(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` ids as the method finds.

    Returns a row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset. Sequences are filled without gaps from 0.

    A null text counts as empty, which is a document of one id. Null and
    repeated doc_ids are kept, a row each; which of several equal rows goes
    where is open. An empty table gives no rows. Other columns are ignored.
    """
    cut = staged(
        docs.sparkSession, pieces(docs, capacity, end_id, path, id_col, text_col), "pieces"
    )
    counts = {row[0]: row[1] for row in cut.groupBy("length").count().collect()}
    runs, _ = plan(counts, capacity)
    order = ["doc_id", "piece", "start", "ids_crc32"]
    ranked = with_rank(cut, sum(counts.values()), order)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    ids = F.col("doc_id").cast("string").alias("doc_id")
    return ranked.select(ids, *cut.columns[1:], "rank").mapInPandas(
        _placer(runs), schema + ", sequence_id long, offset long"
    )
