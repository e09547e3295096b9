"""Byte-level BPE: texts to token ids and back.

A long text is cut into chunks that overlap. Each chunk is split into
pre-tokens on its own, from its own start, so chunks of one text are spread
over tasks. Two splits of the same text that share a boundary agree from there
on, as the pattern never looks back: the first boundary that a chunk and the
next one share in their overlap is where they are stitched. Chunks that share
none there, such as those inside one pre-token of any length, are joined and
split again until every seam has its boundary. Then the pre-tokens between the
seams are encoded. Decoding puts the bytes of the ids one after another.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from askgraph.llm.common import staged

#: Characters of a chunk, and how many it shares with the next one.
CHUNK, OVERLAP = 16_384, 256
#: Chunks whose places may be broadcast, of about 50 bytes each; more are joined by a shuffle.
BROADCAST_PLACES = 2_000_000
#: A pre-token that ends so many characters before the end of a chunk is not told by what follows it.
_GUARD = 4
_ROWS = 512
_CACHED, _CACHED_CHARS = 150_000, 64
_codecs: dict[tuple[str | None, str | None], Codec] = {}


class Codec:
    """A rank file: pre-tokens to ids as 32-bit numbers, ids to bytes."""

    def __init__(self, path: str | None, pattern: str | None):
        import tiktoken

        if path is None or pattern is None:
            import public_tokenizers

            path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
            pattern = pattern or public_tokenizers.PATTERN
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.pattern = regex.compile(pattern)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, number in ranks.items():
            self.bytes_of[number] = token
        self.decimal = [str(i) for i in range(len(self.bytes_of))]
        self.known = _Known(self.library)

    def pre_tokens(self, text: str, start: int = 0, stop: int | None = None) -> list[str]:
        """Matches of the pattern from ``start`` to ``stop``, both boundaries between matches."""
        found = self.pattern.findall(text, start)
        if stop is None or stop == len(text):
            return found
        ends = start + np.cumsum(np.fromiter(map(len, found), "i8", len(found)))
        return found[: int(np.searchsorted(ends, stop, "right"))]

    def ends(self, text: str) -> np.ndarray:
        found = self.pattern.findall(text)
        return np.cumsum(np.fromiter(map(len, found), "i8", len(found)))

    def encode(self, pre_tokens: Iterable[str]) -> bytes:
        return b"".join(map(self.known.__getitem__, pre_tokens))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


class _Known(dict):
    """Ids of pre-tokens met before; emptied where it grows beyond its bound."""

    def __init__(self, library):
        self.library = library

    def __missing__(self, pre_token: str) -> bytes:
        ids = np.array(self.library.encode_ordinary(pre_token), "<i4").tobytes()
        if len(pre_token) <= _CACHED_CHARS:
            if len(self) >= _CACHED:
                self.clear()
            self[pre_token] = ids
        return ids


def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """The worker's own copy, loaded once."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = _ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _id_lists(encoded: list[bytes]) -> pa.Array:
    values = np.frombuffer(b"".join(encoded), "<i4")
    stops = np.cumsum([0, *(len(x) // 4 for x in encoded)]).astype("i4")
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(values))


def _encoded(tool: Codec, batch: pa.RecordBatch) -> list[bytes]:
    """Rows with text, enter and leave: the ids of the pre-tokens between the two."""
    parts = zip(*(batch[c].to_pylist() for c in ("_text", "_enter", "_leave")), strict=True)
    return [tool.encode(tool.pre_tokens(*part)) for part in parts]


def _encoder(path: str | None, pattern: str | None) -> Callable:
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in _slices(batches):
            columns = [*(batch[c] for c in ("_id", "_row", "_piece")), _id_lists(_encoded(tool, batch))]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_row", "_piece", "_ids"])

    return encode


def _cutter(chunk: int, overlap: int) -> Callable:
    """Rows of whole texts: their chunks, with the characters that are a chunk's own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1):
            text = batch["_text"][0].as_py()
            for at in range(0, len(text), chunk * _ROWS):
                starts = range(at, min(len(text), at + chunk * _ROWS), chunk)
                n = len(starts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch["_id"][0]] * n, batch["_id"].type),
                        pa.array([batch["_row"][0].as_py()] * n),
                        pa.array([s // chunk for s in starts], pa.int32()),
                        pa.array([text[s : s + chunk + overlap] for s in starts]),
                        pa.array([min(chunk, len(text) - s) for s in starts], pa.int32()),
                        pa.array([s + chunk + overlap >= len(text) for s in starts]),
                        pa.array([s + chunk >= len(text) for s in starts]),
                    ],
                    ["_id", "_row", "_piece", "_text", "_own", "_to_end", "_last"],
                )

    return cut


def first_shared_boundary(tool: Codec, text: str, own: int, to_end: bool) -> int | None:
    """Where a chunk's split and that of the next one, which starts at ``own``, first agree."""
    trusted = len(text) if to_end else len(text) - _GUARD
    mine = tool.ends(text)
    mine = mine[(mine >= own) & (mine <= trusted)]
    following = np.concatenate([[0], tool.ends(text[own:])]) + own
    shared = np.intersect1d(mine, following)
    return int(shared[0]) if len(shared) else None


def _seams(path: str | None, pattern: str | None) -> Callable:
    def seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in _slices(batches):
            rows = zip(*(batch[c].to_pylist() for c in ("_text", "_own", "_to_end", "_last")), strict=True)
            shared = [
                None if last else first_shared_boundary(tool, text, own, to_end)
                for text, own, to_end, last in rows
            ]
            columns = [batch[c] for c in ("_row", "_piece", "_own", "_last")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(shared, pa.int32())], ["_row", "_piece", "_own", "_last", "_shared"]
            )

    return seams


_SEAMS = "_row string, _piece int, _own int, _last boolean, _shared int"


def _joined(chunks: DataFrame, seams: DataFrame) -> DataFrame:
    """Chunks without a shared boundary at their seam become one with those that follow."""
    order = Window.partitionBy("_row").orderBy("_piece")
    closed = (F.col("_shared").isNotNull() | F.col("_last")).cast("int")
    runs = seams.select(
        "_row", "_piece", (F.sum(closed).over(order) - closed).alias("_run"), closed.alias("_closed")
    )
    part = F.when(F.col("_closed") == 1, F.col("_text")).otherwise(F.expr("substring(_text, 1, _own)"))
    return (
        chunks.join(runs, ["_row", "_piece"])
        .select("*", part.alias("_part"))
        .groupBy("_row", "_run")
        .agg(
            F.first("_id").alias("_id"),
            F.min("_piece").alias("_piece"),
            F.sort_array(F.collect_list(F.struct("_piece", "_part"))).alias("_parts"),
            F.sum("_own").cast("int").alias("_own"),
            F.max_by("_to_end", "_piece").alias("_to_end"),
            F.max_by("_last", "_piece").alias("_last"),
        )
        .withColumn("_text", F.array_join(F.col("_parts")["_part"], ""))
        .select(chunks.columns)
    )


def _stitched(chunks: DataFrame, path: str | None, pattern: str | None) -> DataFrame:
    """Chunks with the places where the pre-tokens that are theirs begin and end."""
    spark = chunks.sparkSession
    while True:
        seams = staged(spark, chunks.mapInArrow(_seams(path, pattern), _SEAMS), "seams")
        if seams.where("_shared is null and not _last").isEmpty():
            break
        chunks = staged(spark, _joined(chunks, seams), "chunks")
    order = Window.partitionBy("_row").orderBy("_piece")
    places = seams.select(
        "_row",
        "_piece",
        F.coalesce(F.lag(F.col("_shared") - F.col("_own")).over(order), F.lit(0)).alias("_enter"),
        F.col("_shared").alias("_leave"),
    )
    if seams.count() <= BROADCAST_PLACES:
        places = F.broadcast(places)
    return chunks.join(places, ["_row", "_piece"])


def _places(
    docs: DataFrame, path: str | None, pattern: str | None, id_col: str, text_col: str, chunk: int, overlap: int
) -> tuple[DataFrame, DataFrame]:
    """Whole texts of up to ``chunk`` characters, and stitched chunks of the longer ones."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(text_col, F.lit("")).alias("_text"))
    short = rows.where(F.length("_text") <= chunk).select(
        "_id",
        F.lit(None).cast("string").alias("_row"),
        F.lit(0).alias("_piece"),
        "_text",
        F.lit(0).alias("_enter"),
        F.lit(None).cast("int").alias("_leave"),
    )
    cut = f"_id {kind}, _row string, _piece int, _text string, _own int, _to_end boolean, _last boolean"
    long = rows.where(F.length("_text") > chunk).select("*", F.expr("uuid()").alias("_row"))
    chunks = staged(docs.sparkSession, long.mapInArrow(_cutter(chunk, overlap), cut), "chunks")
    return short, _stitched(chunks, path, pattern).select(short.columns)


def encode_texts(
    docs: DataFrame,
    path: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """Token ids ``(<id_col>, row, piece, ids)``, in pieces of a text.

    Texts of up to ``chunk`` characters come in one piece without a ``row``;
    longer ones in pieces that share a ``row`` of their own and are in order by
    ``piece``. The ids of a text's pieces in order are its ids. Ids are the
    ranks of the file at ``path``; each match of ``pattern`` is encoded on its
    own and special tokens are ordinary text. A pattern must cover every text
    and must not look back; what it looks ahead, beyond the match it returns,
    may be no more than three characters.

    A null text counts as empty and has no ids. Null and repeated ids are kept,
    repeated rows are encoded each. An empty table gives no rows. Other columns
    are ignored, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [F.col("_id").alias(id_col), *(F.col(f"_{c}").alias(c) for c in ("row", "piece", "ids"))]
    short, long = (
        places.mapInArrow(
            _encoder(path, pattern), f"_id {kind}, _row string, _piece int, _ids array<int>"
        ).select(*names)
        for places in _places(docs, path, pattern, id_col, text_col, chunk, overlap)
    )
    return short.unionByName(long)


def decode_ids(
    pieces: DataFrame, path: str | None = None, pattern: str | None = None, ids_col: str = "ids"
) -> DataFrame:
    """The rows with ``decoded``, the bytes of their ids one after another.

    Null ids are no bytes; an id that the file has not fails. The first of two
    columns of the same name decides.
    """

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in _slices(batches):
            at = batch.schema.names.index(ids_col)
            decoded = [tool.decode(ids or ()) for ids in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )

    decoded = StructType([*pieces.schema.fields, StructField("decoded", BinaryType())])
    return pieces.mapInArrow(decode, decoded)


def _sums(tool: Codec, parts: Iterable[np.ndarray]) -> tuple[int, str, str]:
    n, text, back = 0, hashlib.sha256(), hashlib.sha256()
    for part in parts:
        ids = part.tolist()
        if ids:
            joined = ",".join(map(tool.decimal.__getitem__, ids))
            text.update((f",{joined}" if n else joined).encode())
            back.update(tool.decode(ids))
            n += len(ids)
    return n, text.hexdigest(), back.hexdigest()


def round_trip(
    docs: DataFrame,
    path: str | None = None,
    pattern: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``(<id_col>, n_tokens, ids_sha256, decoded_sha256)`` of each text, encoded and decoded again.

    The ids are those of ``encode_texts`` and stay in the task for texts of one
    chunk; pieces of longer texts are gathered per text.
    """
    short, long = _places(docs, path, pattern, id_col, text_col, chunk, overlap)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    schema = f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path, pattern)
        for batch in _slices(batches):
            found = [_sums(tool, [np.frombuffer(ids, "<i4")]) for ids in _encoded(tool, batch)]
            columns = [pa.array(list(c)) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["_id"], *columns], names)

    def of_pieces(rows):
        places = np.argsort(rows["_piece"].to_numpy(), kind="stable").tolist()
        found = _sums(codec(path, pattern), (rows["_ids"][i].values.to_numpy() for i in places))
        return pa.table([rows["_id"].slice(0, 1), *([x] for x in found)], names)

    pieces = long.mapInArrow(_encoder(path, pattern), f"_id {kind}, _row string, _piece int, _ids array<int>")
    whole = short.mapInArrow(of_texts, schema).unionByName(
        pieces.groupBy("_row").applyInArrow(of_pieces, schema)
    )
    return whole.withColumnRenamed("_id", id_col)
