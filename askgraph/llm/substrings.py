"""Removal of repeated passages with a compressed FM-index per shard.

1. Anchors. Of the 8-word grams in a window the one with the least hash is the
   window's anchor. Equal windows have equal anchors, so only windows whose
   anchor occurs at several places of the corpus can repeat. Anchors are counted
   over all documents; runs of such windows are the segments that go on.
2. Shards. A document goes where its least repeated anchor says, so that copies
   mostly meet; a crowded place is split by document. Each shard of bounded
   size becomes an FM-index over the words of its segments.
3. Own shard. All segments of a shard stream through its index: backward search
   gives the matching statistics, and a window that occurs twice is repeated.
4. Other shards. Windows still open, in runs, stream through other shards, where
   one occurrence is enough. A shard can only hold a window whose code it has, so
   the codes of all windows of all shards meet once, and an open window goes to
   two shards with its code at most: what is sent grows as the open windows do,
   however many shards share a hot passage. A call takes runs of bounded size.
5. Words under repeated windows go; everything else of a text stays.
"""

from __future__ import annotations

import hashlib
import math
import pickle
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from askgraph.llm.common import row_key, staged
from askgraph.llm.fm_index import ORDER, FMIndex, matched_windows

WINDOW = 35
GRAM = 8
SHARD_WORDS = 500_000
_PARTS = 1 << 20
LANE = 256
# Bytes of runs that one call takes, on average, and codes of windows in a row.
PARCEL, CODES = 8_000_000, 50_000


def words_of(text: str | None) -> list[bytes]:
    """Longest runs of characters other than ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least (or greatest) of each ``width`` values in a row."""
    pick, reach = (np.minimum if least else np.maximum), 1
    while 2 * reach <= width:
        values = pick(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def window_anchors(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window, and the hashes of all grams that are one; both signed."""
    if len(words) < window:
        return np.zeros(0, "i8"), np.zeros(0, "i8")
    codes = np.fromiter(map(zlib.crc32, words), "u8", len(words))
    count = len(words) - gram + 1
    mixed = np.zeros(count, "u8")
    for k in range(gram):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    width = window - gram + 1
    least = _slide(mixed, width, True)
    edge = np.zeros(width - 1, "u8")
    reach = _slide(np.concatenate([edge, least, edge]), width, False)
    return least.view("i8"), mixed[reach == mixed].view("i8")


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """Starts and ends (exclusive) of runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype("i1"), [0]])))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]


def anchor_finder(window: int, gram: int):
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [words_of(text) for text in batch["text"]]
            batch["n_words"] = [len(w) for w in words]
            batch["anchors"] = [window_anchors(w, window, gram)[1].tolist() for w in words]
            yield batch[["_k1", "_k2", "n_words", "anchors"]]

    return find


def segment_cutter(window: int, gram: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k1, k2, shard, text, repeated in batch[
                ["_k1", "_k2", "shard", "text", "repeated"]
            ].itertuples(index=False):
                words = words_of(text)
                open_ = np.isin(window_anchors(words, window, gram)[0], repeated)
                for a, b in runs_of(open_):
                    line = b" ".join(words[a : b + window - 1])
                    out.append((k1, k2, shard, a, b - a, line))
            yield pd.DataFrame(out, columns=["_k1", "_k2", "shard", "start", "windows", "words"])

    return cut


def _lanes(first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.arange(first, first + count, LANE)
    return starts, np.minimum(starts + LANE, first + count) - 1


def _parted(segments: list[np.ndarray]) -> np.ndarray:
    """Segments of word numbers in a row, a zero after each."""
    end = np.zeros(1, "i4")
    return np.concatenate([x for s in segments for x in (s, end)])


def _all_words(lines: Iterable[bytes]) -> Iterator[bytes]:
    return chain.from_iterable(map(bytes.split, lines))


def _numbered(lines: Iterable[bytes], numbers: Iterator[int]) -> list[np.ndarray]:
    """The numbers of all words in a row, cut into those of each line."""
    ends = np.cumsum([line.count(b" ") + 1 for line in lines])
    return np.split(np.fromiter(numbers, "i4", ends[-1]), ends[:-1])


def _search(index: FMIndex, segments: list[np.ndarray], window: int, least: int) -> list[np.ndarray]:
    """Flags of the repeated windows of each segment of word numbers."""
    text = _parted(segments)
    place = np.cumsum([0, *(len(s) + 1 for s in segments)])[:-1]
    counts = [len(s) - window + 1 for s in segments]
    lanes = [_lanes(int(p), c) for p, c in zip(place, counts, strict=True)]
    first = np.concatenate([x for x, _ in lanes])
    last = np.concatenate([x for _, x in lanes])
    hit = matched_windows(index, text, first, last, window, least)
    return [hit[p : p + c] for p, c in zip(place, counts, strict=True)]


def window_codes(text: np.ndarray, vocabulary: Iterable[bytes], window: int) -> np.ndarray:
    """A code of each window of word numbers; equal words have equal codes in every shard."""
    digests = (hashlib.blake2b(word, digest_size=8).digest() for word in vocabulary)
    codes = np.frombuffer(b"".join([bytes(8), *digests]), "<u8")[text]
    count = max(0, len(codes) - window + 1)
    mixed = np.zeros(count, "u8")
    for k in range(window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + codes[k : k + count]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    return mixed.view("i8")


_FOUND = "kind string, shard long, _k1 long, _k2 long, start long, stop long, data binary, codes array<long>"


def _found(rows: list[tuple]) -> pd.DataFrame:
    columns = ["kind", "shard", "_k1", "_k2", "start", "stop", "data", "codes"]
    return pd.DataFrame(rows, columns=columns)


def shard_indexer(window: int, gram: int):
    """Index the segments of a shard, settle what repeats within, pass on the rest."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_k1", "_k2", "start"], kind="stable")
        shard = int(rows["shard"].iloc[0])
        words = dict.fromkeys(_all_words(rows["words"]))
        vocabulary = dict(zip(words, range(1, len(words) + 1), strict=True))
        segments = _numbered(rows["words"], map(vocabulary.__getitem__, _all_words(rows["words"])))
        text = _parted(segments)
        index = FMIndex.build(text, vocabulary, max(ORDER, window))
        # no nulls in whole-number columns: pandas would turn them into floats
        out = [("index", shard, 0, 0, 0, 0, index.dump(), None)]
        hits = _search(index, segments, window, 2)
        codes = window_codes(text, vocabulary, window)
        place, held = 0, []
        for (k1, k2, start, line), hit in zip(
            rows[["_k1", "_k2", "start", "words"]].itertuples(index=False), hits, strict=True
        ):
            own = codes[place : place + len(hit)]
            place += len(hit) + window  # the segment's last words, and what parts it from the next
            held.append(own)
            for a, b in runs_of(hit):
                out.append(("hit", shard, k1, k2, start + a, start + b + window - 1, None, None))
            for a, b in runs_of(~hit):
                data = b" ".join(line.split()[a : b + window - 1])
                out.append(("open", shard, k1, k2, start + a, start + b, data, own[a:b].tolist()))
        held = np.unique(np.concatenate(held))
        for at in range(0, len(held), CODES):
            out.append(("held", shard, 0, 0, 0, 0, None, held[at : at + CODES].tolist()))
        return _found(out)

    return run


def parcel(window: int):
    """The open windows of a shard, in runs, for each other shard they go to as one value."""

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        to: dict[int, list[tuple]] = {}
        columns = ["_k1", "_k2", "start", "windows", "data", "sent"]
        for k1, k2, start, windows, data, sent in rows[columns].itertuples(index=False, name=None):
            words = data.split()
            targets, at = (np.array([s[name] for s in sent], "i8") for name in ("target", "at"))
            for target in np.unique(targets):
                flags = np.zeros(windows, bool)
                flags[at[targets == target]] = True
                for a, b in runs_of(flags):
                    run = (k1, k2, start + a, b" ".join(words[a : b + window - 1]))
                    to.setdefault(int(target), []).append(run)
        out = [(target, pickle.dumps(runs)) for target, runs in to.items()]
        return pd.DataFrame(out, columns=["target", "runs"])

    return pack


def shard_streamer(window: int):
    """Stream runs of open windows through the index of another shard."""

    def run(index_rows: pd.DataFrame, parcels: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index_rows) and len(parcels):
            index = FMIndex.load(index_rows["data"].iloc[0])
            known = index.vocabulary
            # one search for all of them: it advances many windows at a time
            runs = [run for data in parcels["runs"] for run in pickle.loads(data)]
            lines = [run[3] for run in runs]
            segments = _numbered(lines, map(known.get, _all_words(lines), repeat(-1)))
            hits = _search(index, segments, window, 1)
            for (k1, k2, start, _), hit in zip(runs, hits, strict=True):
                out += [(k1, k2, start + a, start + b + window - 1) for a, b in runs_of(hit)]
        return pd.DataFrame(out, columns=["_k1", "_k2", "start", "stop"])

    return run


def _kept(text: str | None, spans: list | None) -> tuple[list[bytes], int]:
    words = words_of(text)
    gone = np.zeros(len(words) + 1, "i8")
    for span in [] if spans is None else spans:
        gone[span["start"]] += 1
        gone[span["stop"]] -= 1
    stays = np.cumsum(gone)[:-1] == 0
    return [w for w, s in zip(words, stays, strict=True) if s], len(words)


def rewriter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, text, spans in batch[["doc_id", "text", "spans"]].itertuples(index=False):
            kept, count = _kept(text, spans)
            line = b" ".join(kept)
            out.append((doc_id, count, count - len(kept), line, hashlib.sha256(line).hexdigest()))
        rows = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])
        rows["doc_id"] = rows["doc_id"].astype("Int64")
        rows["kept"] = [line.decode("utf-8", "surrogatepass") for line in rows["kept"]]
        yield rows


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS
) -> DataFrame:
    """Spans of words under repeated windows, for docs of _k1, _k2 (a key) and text.

    Returns _k1, _k2, spans (array of start and stop, in words).
    """
    spark = docs.sparkSession
    anchors = staged(
        spark,
        docs.mapInPandas(anchor_finder(window, gram), "_k1 long, _k2 long, n_words long, anchors array<long>"),
        "anchors",
    )
    several = (
        anchors.select(F.explode("anchors").alias("anchor"))
        .groupBy("anchor")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("anchor").alias("_several"))
    )
    distinct = F.array_distinct("anchors")
    again = F.size("anchors") - F.size(distinct)
    per_doc = staged(
        spark,
        anchors.select("_k1", "_k2", "n_words", again.alias("again"), F.explode(distinct).alias("anchor"))
        .join(several, F.col("anchor") == F.col("_several"))
        .groupBy("_k1", "_k2")
        .agg(
            F.collect_set("anchor").alias("repeated"),
            F.max("n_words").alias("n_words"),
            F.max("again").alias("again"),
            F.count("*").alias("_found"),
        )
        .withColumn("place", F.array_min("repeated")),
        "repeated",
    )
    # an anchor stands for about half its window of words that nothing else covers, each time it occurs
    covered = (F.size("repeated") + F.col("again")) * F.lit((window - gram) // 2 + window // 2)
    equal_rows = F.ceil(F.col("_found") / F.size("repeated"))
    share = F.least("n_words", covered) * equal_rows
    total = per_doc.agg(F.sum(share)).first()[0] or 0
    bases = max(1, math.ceil(total / shard_words))
    placed = per_doc.withColumn("base", F.pmod(F.xxhash64("place"), F.lit(bases)).cast("int"))
    crowds = placed.groupBy("base").agg(F.ceil(F.sum(share) / F.lit(1.5 * shard_words)).alias("parts"))
    # a shard's number is that of its base and, beside it, that of its part
    part = F.pmod(F.xxhash64("_k1", "_k2"), F.greatest("parts", F.lit(1)))
    shard = F.col("base").cast("long") * F.lit(_PARTS) + F.pmod(part, F.lit(_PARTS))
    placed = placed.join(crowds, "base")
    placed = staged(
        spark, placed.select("_k1", "_k2", "repeated", shard.alias("shard")), "placed"
    )
    keys = placed.select(F.col("_k1").alias("_p1"), F.col("_k2").alias("_p2"), "repeated", "shard")
    segments = (
        docs.join(keys, (F.col("_k1") == F.col("_p1")) & (F.col("_k2") == F.col("_p2")))
        .select("_k1", "_k2", "shard", "text", "repeated")
        .mapInPandas(
            segment_cutter(window, gram),
            "_k1 long, _k2 long, shard long, start long, windows long, words binary",
        )
    )
    found = staged(
        spark,
        segments.groupBy("shard").applyInPandas(shard_indexer(window, gram), _FOUND),
        "indexes",
    )
    # shards in an order that differs by code, so that no shard comes first for all hot windows
    held = (
        found.where("kind = 'held'")
        .select("shard", F.explode("codes").alias("code"))
        .repartition("code")
        .withColumn("_of", F.col("shard").bitwiseXOR(F.col("code")))
        .groupBy("code")
        .agg(F.min("_of").alias("_least"), F.max("_of").alias("_most"))
        .where("_least < _most")
        .select("code", *[F.col(c).bitwiseXOR(F.col("code")).alias(c) for c in ("_least", "_most")])
    )
    open_ = found.where("kind = 'open'").select("_k1", "_k2", "start", "shard", "data", "codes")
    elsewhere = F.filter(F.array("_least", "_most"), lambda home: home != F.col("shard"))
    sent = (
        open_.select("_k1", "_k2", "start", "shard", F.posexplode("codes").alias("at", "code"))
        .join(held, "code")
        .select("_k1", "_k2", "start", "shard", "at", F.explode(elsewhere).alias("target"))
        .groupBy("_k1", "_k2", "start", "shard")
        .agg(F.collect_list(F.struct("target", "at")).alias("sent"))
    )
    leaving = staged(
        spark,
        open_.withColumn("windows", F.size("codes"))
        .drop("codes")
        .join(sent, ["_k1", "_k2", "start", "shard"]),
        "open-windows",
    )

    def calls(size: Column) -> Column:
        return F.greatest(F.ceil(F.sum(size) / F.lit(PARCEL)), F.lit(1))

    loads = leaving.groupBy("shard").agg(calls(F.length("data") + 16 * F.size("sent")).alias("loads"))
    load = F.pmod(F.xxhash64("_k1", "_k2", "start"), F.col("loads"))
    parcels = staged(
        spark,
        leaving.join(loads, "shard")
        .withColumn("load", load)
        .groupBy("shard", "load")
        .applyInPandas(parcel(window), "target long, runs binary"),
        "parcels",
    )
    parts = parcels.groupBy("target").agg(calls(F.length("runs")).alias("calls"))
    call = F.pmod(F.xxhash64("runs"), F.col("calls"))
    parcels = parcels.join(parts, "target").select("target", call.alias("call"), "runs")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("calls") - 1)).alias("call")
    indexes = (
        found.where("kind = 'index'")
        .select(F.col("shard").alias("target"), "data")
        .join(parts, "target")
        .select("target", each, "data")
    )
    foreign = (
        indexes.groupBy("target", "call")
        .cogroup(parcels.groupBy("target", "call"))
        .applyInPandas(shard_streamer(window), "_k1 long, _k2 long, start long, stop long")
    )
    hits = found.where("kind = 'hit'").select("_k1", "_k2", "start", "stop").unionByName(foreign)
    return hits.groupBy("_k1", "_k2").agg(
        F.collect_set(F.struct("start", "stop")).alias("spans")
    )


def remove_repeats(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    shard_words: int = SHARD_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents without the words that repeated windows cover.

    A window is ``window`` words in a row of one document (words are runs of
    characters other than ASCII white space); it repeats if its words also start
    anywhere else, in the same document too. Windows are judged on the input.
    Returns doc_id, n_words, n_removed, kept (the other words, joined by a
    space) and kept_sha256 (of its UTF-8 bytes).

    A null text has no words, and texts shorter than a window stay whole. Null
    doc_ids are rows like others. A repeated row is a second document: its
    windows repeat. An empty table gives no rows. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("*", *row_key("doc_id", "text"))
    spans = repeated_spans(rows.select("_k1", "_k2", "text"), window, gram, shard_words)
    spans = staged(spark, spans, "spans").select(
        F.col("_k1").alias("_s1"), F.col("_k2").alias("_s2"), "spans"
    )
    return (
        rows.join(spans, (F.col("_k1") == F.col("_s1")) & (F.col("_k2") == F.col("_s2")), "left")
        .select("doc_id", "text", "spans")
        .mapInPandas(
            rewriter, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string"
        )
    )


SQL = r"""
with w as (
  select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws
  from documents
), starts as (
  select doc_id, ws, unnest(generate_series(1, len(ws) - 34)) as s from w where len(ws) >= 35
), counted as (
  select doc_id, s, count(*) over (partition by md5(array_to_string(ws[s : s + 34], ' '))) as n from starts
), bad as (
  select doc_id, list(s) as ss from counted where n > 1 group by doc_id
), gone as (
  select doc_id, list_distinct(flatten(list_transform(ss, lambda s: generate_series(s, s + 34)))) as g from bad
), kept as (
  select w.doc_id, len(ws) as n_words,
         case when g is null then ws
              else list_filter(ws, lambda x, i: not list_contains(g, i)) end as k
  from w left join gone using (doc_id)
)
select doc_id, n_words::bigint as n_words, (n_words - len(k))::bigint as n_removed,
       sha256(array_to_string(k, ' ')) as kept_sha256
from kept
"""
