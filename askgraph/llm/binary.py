"""Token-id matrices for training, packed best fit decreasing.

Pieces of documents are dealt over shards by hash. Within a shard, pieces are
taken by falling length, and a segment tree over the room left in sequences
finds the fullest one that still holds a piece in logarithmic time. A shard
holds a bounded number of tokens, so its packing fits one task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from askgraph.llm.packing import CAPACITY, END_ID, pieces

#: Characters of text per shard, about; a token is 2 to 4 of them.
SHARD_CHARS = 24_000_000


class CapacityTree:
    """Open sequences by the room left in them: a segment tree of counts over 0..capacity."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)
        self.members: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += change
            node >>= 1

    def put(self, room: int, sequence: int) -> None:
        self.members[room].append(sequence)
        self._add(room, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """Remove and return (room, sequence) with the least room of at least ``length``."""
        node = length + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.size
        self._add(room, -1)
        return room, self.members[room].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Indices of the pieces in each sequence, in their order there."""
    tree, sequences = CapacityTree(capacity), []
    for index in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[index])
        found = tree.take(length)
        if found is None:
            room, number = capacity, len(sequences)
            sequences.append([])
        else:
            room, number = found
        sequences[number].append(index)
        if room > length:
            tree.put(room - length, number)
    return sequences


def packer(capacity: int, pad_id: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "piece", "tie"], kind="stable")
        lengths = rows["length"].to_numpy()
        flat = np.frombuffer(b"".join(rows["ids"]), "<u2")
        begins = np.concatenate([[0], np.cumsum(lengths)])
        names = rows["doc_id"].tolist()
        pieces, starts = rows["piece"].tolist(), rows["start"].tolist()
        ramp = np.arange(capacity, dtype="<u2")
        sequences = best_fit_decreasing(lengths, capacity)
        ids = np.full((len(sequences), capacity), pad_id, "<u2")
        positions = np.zeros((len(sequences), capacity), "<u2")
        segments, cuts = [], []
        for number, members in enumerate(sequences):
            cut = [0]
            for member in members:
                at, n = cut[-1], int(lengths[member])
                ids[number, at : at + n] = flat[begins[member] : begins[member] + n]
                positions[number, at : at + n] = ramp[:n]
                cut.append(at + n)
            cuts.append(cut)
            segments.append(
                [
                    {"doc_id": None if pd.isna(names[m]) else int(names[m]), "piece": pieces[m], "start": starts[m]}
                    for m in members
                ]
            )
        return pd.DataFrame(
            {
                "shard": rows["shard"].iloc[0],
                "row": np.arange(len(sequences), dtype="i4"),
                "input_ids": [row.tobytes() for row in ids],
                "cu_seqlens": cuts,
                "position_ids": [row.tobytes() for row in positions],
                "segments": segments,
            }
        )

    return pack


def packed_matrices(
    docs: DataFrame,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    pad_id: int = 0,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """A row per training sequence of ``capacity`` ids, ready to be written.

    Columns: shard and row (its place in the shard's matrix), input_ids
    (``capacity`` unsigned little-endian 16-bit numbers, padded with
    ``pad_id``), cu_seqlens (0 and the end of each segment), position_ids (16
    bit; they restart at 0 in each segment and are 0 in the padding), segments
    (doc_id, piece and start of each piece in the sequence). Overlong documents
    are cut into pieces and nothing is lost: their pieces in order are the ids.

    The vocabulary must have at most 65,536 ids and ``capacity`` at most as
    many. A null text counts as empty, a document of one id. Null and repeated
    doc_ids are kept. An empty table gives no rows. Other columns are ignored.
    """
    chars = docs.agg(F.sum(F.length(text_col).cast("long")), F.count("*")).first()
    shards = max(1, math.ceil(((chars[0] or 0) + 8 * chars[1]) / shard_chars))
    cut = pieces(docs, capacity, end_id, path, id_col, text_col, with_ids=True, width=2)
    shard = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("int")
    return (
        cut.select("doc_id", "piece", "start", "length", "ids", F.xxhash64("ids").alias("tie"), shard.alias("shard"))
        .groupBy("shard")
        .applyInPandas(
            packer(capacity, pad_id),
            "shard int, row int, input_ids binary, cu_seqlens array<int>, position_ids binary, "
            "segments array<struct<doc_id:long,piece:int,start:long>>",
        )
    )


def write_matrices(packed: DataFrame, path: str) -> DataFrame:
    """Write the sequences to Parquet, a folder per shard, rows in the shard's order; the table read back.

    A shard comes out of one task in that order, so nothing is moved for it. An
    empty table is written as one, with its schema.
    """
    packed.write.mode("overwrite").partitionBy("shard").parquet(path)
    return packed.sparkSession.read.schema(packed.schema).parquet(path).select(packed.columns)


def digest(packed: DataFrame) -> DataFrame:
    """A row per sequence with checksums in place of the matrices' rows."""
    return packed.select(
        "shard",
        "row",
        (F.size("cu_seqlens") - 1).alias("n_segments"),
        F.element_at("cu_seqlens", -1).cast("long").alias("n_ids"),
        F.crc32("input_ids").alias("input_ids_crc32"),
        F.crc32("position_ids").alias("position_ids_crc32"),
        F.array_join("cu_seqlens", ",").alias("cu_seqlens"),
        F.array_join(
            F.transform(
                "segments",
                lambda s: F.concat_ws(
                    ":", F.coalesce(s["doc_id"].cast("string"), F.lit("")), s["piece"], s["start"]
                ),
            ),
            ",",
        ).alias("segments"),
    )

