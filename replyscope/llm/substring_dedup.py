"""Exact removal of repeated word windows with an FM-index per shard.

A window is ``size`` consecutive words. A run is a maximal stretch of windows
of one document with the same minimizer (the smallest hash of ``ANCHOR``
words); equal windows have equal minimizers, so windows only need comparing
under one minimizer, and minimizers met once are dropped at once. Equal runs
collapse to one segment with the smallest and the largest document id that has
it. Segments are dealt to shards by minimizer; under a minimizer with very many
different segments, single windows are dealt instead, equal ones collapsed
first, so no shard depends on how often something occurs.

A shard sorts its segments' suffixes, keeps the Burrows-Wheeler transform in a
wavelet matrix of packed bits, and streams every segment through it backwards.
Where a window's interval is found, the smallest document id over the interval
tells which documents lose the window."""
from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import Words, map_batches, mix, only, signed, text_bytes

ANCHOR = 4
PLACE = np.uint64((1 << 21) - 1)
SHARD_WORDS = 200_000
MANY_SEGMENTS = 2_000     # of one minimizer; beyond it its windows are dealt one by one


# ------------------------------------------------------------------- runs
def minimizer_runs(words: Words, size: int) -> tuple[np.ndarray, ...]:
    """Per run: minimizer, content hash, row, first word, number of windows."""
    at, whole = words.windows(size)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none.view(np.uint64), none, none, none
    n = len(words.hash) - ANCHOR + 1
    anchor = np.zeros(n, dtype=np.uint64)
    for j in range(ANCHOR):
        anchor = (anchor + words.hash[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        anchor ^= anchor >> np.uint64(29)
    anchor = mix(anchor)
    # The smallest of a window's anchors by their upper bits, the first of equal
    # ones: the lower bits hold the place, and the reach of the minimum doubles.
    best = anchor & ~PLACE | np.arange(n, dtype=np.uint64) & PLACE
    reach, span = 1, size - ANCHOR + 1
    while reach < span:
        step = min(reach, span - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    where = at + (best[at] - at.astype(np.uint64) & PLACE).astype(np.int64)
    new = np.ones(len(at), dtype=bool)
    new[1:] = where[1:] != where[:-1]
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at)))
    content = mix(whole[first] ^ mix(whole[first + length - 1] + length.astype(np.uint64)))
    row = words.row[at[first]]
    return anchor[where[first]], content, row, at[first] - words.first[row], length


def _runs(docs: DataFrame, size: int) -> DataFrame:
    """``key, content, doc_id, place``; ``place`` is the first word of the run
    times 16 (a run has at most 10 windows) plus its number of windows."""
    def batch(part: pa.RecordBatch, _):
        words = Words(*text_bytes(part.column(1)))
        key, content, row, start, length = minimizer_runs(words, size)
        return {"key": signed(key), "content": signed(content),
                "doc_id": part.column(0).take(pa.array(row)), "place": start * 16 + length}

    return map_batches(docs, batch, "key bigint, content bigint, doc_id bigint, place bigint",
                       text="text")


# --------------------------------------------------------------- FM-index
class FMIndex:
    """Index of a sequence of symbols 0..top; 0 parts the segments. Suffixes
    are sorted by their first 16 symbols, enough for patterns of up to 15."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        rank = symbols.astype(np.int64)
        step = 1
        while step < 16:
            ahead = np.zeros(n, dtype=np.int64)
            ahead[:n - step] = rank[step:] + 1 if step < n else 0
            key = rank * (n + 2) + ahead
            order = np.argsort(key)     # equal keys get equal ranks, in any order
            new = np.ones(n, dtype=np.int64)
            new[1:] = key[order][1:] != key[order][:-1]
            rank = np.empty(n, dtype=np.int64)
            rank[order] = np.cumsum(new)
            step *= 2
        self.places = np.argsort(rank)
        last = symbols[self.places - 1]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        self.levels = []
        for bit in range(max(1, int(symbols.max()).bit_length()) - 1, -1, -1):
            ones = (last >> bit & 1).astype(bool)
            packed = np.packbits(np.concatenate([ones, np.zeros(64 - n % 64, dtype=bool)]),
                                 bitorder="little").view(np.uint64)
            blocks = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.levels.append((bit, packed, blocks[:-1], n - int(ones.sum())))
            last = np.concatenate([last[~ones], last[ones]])
        alphabet = np.arange(len(self.first) - 1)
        self.base = self._down(alphabet, np.zeros(len(alphabet), dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Positions followed down the wavelet matrix along the symbols' bits."""
        for bit, packed, blocks, zeros in self.levels:
            block = at >> 6
            below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = blocks[block] + np.bitwise_count(packed[block] & below)
            at = np.where(symbol >> bit & 1, zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) \
            -> tuple[np.ndarray, np.ndarray]:
        """One backward step of all patterns at once."""
        shift = self.first[symbol] - self.base[symbol]
        return self._down(symbol, low) + shift, self._down(symbol, high) + shift


def repeated_windows(segments: tuple[np.ndarray, np.ndarray], first: np.ndarray,
                     last: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Segment, window and smallest document id of each window that a document
    of a smaller id has too, as seen from the segment's largest id. Segments
    are their words one after the other and the length of each."""
    values, length = segments
    _, local = np.unique(values, return_inverse=True)
    total = int(length.sum() + len(length))
    start = np.concatenate([[0], np.cumsum(length + 1)[:-1]])
    owner = np.repeat(np.arange(len(length)), length + 1)
    symbols = np.zeros(total, dtype=np.int64)
    inside = np.ones(total, dtype=bool)
    inside[start + length] = False
    symbols[inside] = local + 1
    index = FMIndex(symbols)
    count = length - size + 1
    segment = np.repeat(np.arange(len(length)), count)
    window = np.arange(len(segment)) - np.repeat(np.cumsum(count) - count, count)
    at = start[segment] + window
    c = symbols[at + size - 1]
    low, high = index.first[c], index.first[c + 1]
    single = first[segment] == last[segment]
    for j in range(size - 2, -1, -1):
        # A window that only one document has needs another place to match.
        alive = (high - low > 1) | ~single
        segment, window, at, low, high, single = (
            x[alive] for x in (segment, window, at, low, high, single))
        low, high = index.extend(symbols[at + j], low, high)
    if not len(segment):
        return segment, window, segment
    least = np.append(first[owner[index.places]], np.iinfo(np.int64).max)
    begin, inverse = np.unique(low, return_inverse=True)
    end = np.zeros(len(begin), dtype=np.int64)
    end[inverse] = high
    smallest = np.minimum.reduceat(least, np.stack([begin, end], axis=1).ravel())[::2][inverse]
    hit = smallest < last[segment]
    return segment[hit], window[hit], smallest[hit]


# ------------------------------------------------------------------ stages
def _segments(docs: DataFrame, reps: DataFrame, size: int, single: bool) -> DataFrame:
    """Words of the representatives' segments, as hashes, read from the texts;
    ``single`` makes a segment of each window, named by its own hash."""
    per_doc = reps.groupBy("doc_id").agg(F.collect_list(F.struct(
        "key", "content", "first", "last", "place")).alias("runs"))
    joined = docs.join(per_doc, "doc_id").select("text", "runs")

    def batch(part: pa.RecordBatch, _):
        words = Words(*text_bytes(part.column(0)))
        runs = part.column(1)
        row = np.repeat(np.arange(part.num_rows), pc.list_value_length(runs).to_numpy())
        key, content, low, high, place = (x.to_numpy() for x in runs.flatten().flatten())
        start, n = place >> 4, place & 15
        # A run that is too long for the text is of another row under the same id.
        fits = np.flatnonzero(start + n + size - 1 <= np.diff(words.first)[row])
        offset = np.zeros(len(fits), dtype=np.int64)
        if single:
            offset = _counting(n[fits])
            fits = np.repeat(fits, n[fits])
        begin = words.first[row[fits]] + start[fits] + offset
        length = np.full(len(fits), size) if single else n[fits] + size - 1
        route = signed(window_hash(words.hash, begin, size)) if single else key[fits]
        ends = np.concatenate([[0], np.cumsum(length)])
        pieces = words.hash[np.repeat(begin, length) + _counting(length)]
        return {"route": route, "content": content[fits], "offset": offset, "first": low[fits],
                "last": high[fits],
                "words": pa.Array.from_buffers(pa.large_binary(), len(fits), [
                    None, pa.py_buffer(ends * 8), pa.py_buffer(pieces)])}

    return map_batches(joined, batch, "route bigint, content bigint, offset int, first bigint, "
                                      "last bigint, words binary", text="text")


def _counting(lengths: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... for each length, one after the other."""
    return np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def window_hash(hashes: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(len(begin), dtype=np.uint64)
    for j in range(size):
        out = mix((out + hashes[begin + j]) * np.uint64(0x9E3779B97F4A7C15))
    return out


def _search(segments: DataFrame, shards: int, size: int) -> DataFrame:
    """``content, low, mask``: windows (bits of the mask) of a segment that a
    document ``low`` has, for the documents of larger id that have it."""
    dealt = segments.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))

    def shard(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        whole = table["words"].combine_chunks()
        values, ends = text_bytes(whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole)
        segment, window, low = repeated_windows((values.view(np.uint64), np.diff(ends) // 8),
                                                table["first"].to_numpy(),
                                                table["last"].to_numpy(), size)
        found = pd.DataFrame({"content": table["content"].to_numpy()[segment], "low": low,
                              "mask": np.int64(1) << window})
        # The same content may come from two rows under one id.
        found = found.drop_duplicates()
        found = found.groupby(["content", "low"], as_index=False, sort=False)["mask"].sum()
        return pa.table({c: found[c].to_numpy() for c in ("content", "low", "mask")})

    return (dealt.select("shard", "content", "first", "last", "words").groupBy("shard")
            .applyInArrow(shard, "content bigint, low bigint, mask bigint"))


def repeated_runs(df: DataFrame, size: int = 13, scratch: Scratch | None = None,
                  shard_words: int = SHARD_WORDS, many: int = MANY_SEGMENTS) -> DataFrame:
    """``doc_id, marks``: where a document loses windows; a mark is the word at
    which a run starts and the bits of the run's lost windows."""
    scratch = scratch or Scratch(df.sparkSession)
    docs = only(df, doc_id="bigint", text="string")
    runs = _runs(docs.where("doc_id is not null"), size)
    # A table of its own, so that both sides of the join are plain shuffles and
    # a minimizer with very many runs is split over tasks.
    again = scratch.table(runs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
                          .select("key"))
    kept = scratch.table(runs.join(again, "key"))
    scratch.drop(again)
    contents = scratch.table(
        kept.groupBy("key", "content")
        .agg(F.min(F.struct("doc_id", "place")).alias("at"), F.max("doc_id").alias("last"))
        .select("key", "content", "at.doc_id", "at.place", F.col("at.doc_id").alias("first"),
                "last"))
    per_key = scratch.table(contents.groupBy("key").agg(
        F.count("*").alias("segments"), F.min("first").alias("low"), F.max("last").alias("high"))
        .where("low < high").select("key", "segments"))
    useful = contents.join(per_key, "key")
    normal, crowded = useful.where(F.col("segments") <= many), useful.where(F.col("segments") > many)
    n_words = normal.select(F.sum(F.col("place").bitwiseAND(15) + size - 1)).first()[0] or 0
    windows = scratch.table(_segments(docs, crowded, size, single=True))
    alike = windows.groupBy("route").agg(F.min("first").alias("first"), F.max("last").alias("last"),
                                         F.first("words").alias("words"), F.count("*").alias("n"))
    n_windows = windows.select("route").distinct().count()
    shards = max(1, -(-int(n_words + n_windows * size) // shard_words))
    columns = ["route", "content", "first", "last", "words"]
    found = scratch.table(_search(
        _segments(docs, normal, size, single=False).select(*columns)
        .union(alike.withColumn("content", F.col("route")).select(*columns)), shards, size))
    scratch.drop(contents)
    scratch.drop(per_key)
    marks = found.join(windows.select(F.col("content").alias("whole"), "offset",
                                      F.col("route").alias("content")).distinct(), "content", "left") \
        .select(F.coalesce("whole", "content").alias("content"), "low",
                F.coalesce(F.expr("shiftleft(1L, offset)"), F.col("mask")).alias("mask"))
    return (kept.join(marks, "content").where(F.col("doc_id") > F.col("low"))
            .groupBy("doc_id").agg(F.collect_list(F.struct("place", "mask")).alias("marks")))


def remove_repeats(df: DataFrame, size: int = 13, scratch: Scratch | None = None,
                   shard_words: int = SHARD_WORDS, many: int = MANY_SEGMENTS,
                   carry: str = "") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256``, and
    the columns of ``carry`` (a schema over columns of ``df``) with
    ``kept_text``, if any are asked for.

    A word goes if a window that covers it also starts in a document with a
    smaller id; the input decides, not what is left of it. A null, empty or
    short text loses nothing; rows that share an id are one document, so they
    do not count against each other; a row without an id loses nothing and
    counts against no other; an empty table gives no rows. ``kept_text`` is the
    text as it was if nothing goes, else the kept words joined by a space."""
    docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                     F.col("text").cast("string").alias("text"))
    marks = repeated_runs(df, size, scratch, shard_words, many)
    if carry:
        whole = df.sparkSession.createDataFrame([], carry).schema
        docs = df.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                         F.col("text").cast("string").alias("text"),
                         F.struct(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name)
                                    for f in whole]).alias("row"))
    joined = docs.join(marks, "doc_id", "left")

    def batch(part: pa.RecordBatch, _):
        columns = {n: part.column(i) for i, n in enumerate(part.schema.names)}
        out = {"doc_id": columns["doc_id"], "n_words": [], "n_removed": [], "kept_sha256": []}
        texts = []
        for text, marked in zip(columns["text"].to_pylist(), columns["marks"].to_pylist()):
            words = (text or "").encode().split()       # at the same six white-space bytes
            left = words
            if marked:
                gone = bytearray(len(words))
                for m in marked:
                    start, mask = m["place"] >> 4, m["mask"]
                    if start + size > len(words):
                        continue        # marks of another row under this id
                    for bit in range(mask.bit_length()):
                        if mask >> bit & 1:
                            gone[start + bit:start + bit + size] = b"\1" * size
                left = [w for w, g in zip(words, gone) if not g]
            joined_words = b" ".join(left)
            out["n_words"].append(len(words))
            out["n_removed"].append(len(words) - len(left))
            out["kept_sha256"].append(hashlib.sha256(joined_words).hexdigest())
            texts.append(joined_words.decode() if len(left) < len(words) else text or "")
        if carry:
            out |= {"row": columns["row"], "kept_text": texts}
        return out

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    if carry:
        schema += f", row struct<{carry}>, kept_text string"
    return map_batches(joined, batch, schema, text="text")
