"""Best-fit-decreasing packing of tokenised documents into fixed sequences.

There are at most ``capacity`` distinct piece lengths, so the whole of
best-fit decreasing can be worked out from the histogram of lengths: taking
the lengths from long to short, a segment tree over remaining capacities finds
the tightest open bin in logarithmic time, and all bins of one remaining
capacity that get the same next pieces are handled as one range. The plan (a
few ranges per length) says where the r-th piece of a length goes. Pieces get
their rank within their length in Spark, in hashed buckets whose offsets are
summed, so a length that a third of all pieces share is still spread."""
from __future__ import annotations

import json
import os
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import map_batches, only
from .token_counts import byte_symbols

ROWS_PER_BUCKET = 2_000
PIECES = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
# The pre-tokeniser entry of a byte-level file, and its pattern.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
              "use_regex": True}
PRE_TOKENS = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")


# ------------------------------------------------------------------ tokens
class Encoder:
    """Token ids as little-endian unsigned 32-bit bytes.

    The vocabulary of a byte-level file is read once and run as ranks, which
    gives the ids of the ``tokenizers`` library several times faster. Texts
    with a special string go to that library itself, because it matches those
    before it cuts a text."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] \
                or spec["pre_tokenizer"] != BYTE_LEVEL:
            raise ValueError("not a byte-level BPE file")
        byte = {c: b for b, c in enumerate(byte_symbols())}
        self.ranks = tiktoken.Encoding(
            os.path.basename(path), pat_str=PRE_TOKENS, special_tokens={},
            mergeable_ranks={bytes(map(byte.__getitem__, t)): i
                             for t, i in spec["model"]["vocab"].items()})

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranks.encode_ordinary(text)
        return np.asarray(ids, dtype="<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut_pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece. A document is its ids and ``end_id``; one longer
    than ``capacity`` is cut into full pieces, the first one shorter if need
    be."""
    tail = np.asarray([end_id], dtype="<u4").tobytes()

    def batch(part: pa.RecordBatch, tokens: Encoder):
        ids = part.column(0).to_pylist()
        out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc_id, text in zip(ids, part.column(1).to_pylist()):
            raw = tokens.encode(text or "") + tail
            total = len(raw) // 4
            at, piece = 0, 0
            end = total % capacity or min(total, capacity)
            while at < total:
                out["doc_id"].append(doc_id)
                out["piece"].append(piece)
                out["start"].append(at)
                out["length"].append(end - at)
                out["ids_crc32"].append(zlib.crc32(raw[4 * at:4 * end]))
                at, end, piece = end, end + capacity, piece + 1
        return out

    return map_batches(only(df, doc_id="bigint", text="string"), batch, PIECES, text="text",
                       setup=lambda: encoder(tokenizer))


# ------------------------------------------------------------------- plan
class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: how many open bins
    have each, and the smallest one of at least a given size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, n: int) -> None:
        at = self.leaves + remaining
        while at:
            self.count[at] += n
            at //= 2

    def tightest(self, need: int) -> int | None:
        at = self.leaves + need
        if self.count[at]:
            return need
        while at > 1:       # up to the first right sibling with an open bin
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.leaves:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        return at - self.leaves


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Ranges ``length, first, per_bin, bin, offset``: the piece of that
    length and rank ``r`` (from ``first`` up to the next range's) is in bin
    ``bin + (r - first) // per_bin`` at ``offset + ((r - first) % per_bin) *
    length``."""
    tree = CapacityTree(capacity)
    open_bins: dict[int, deque] = {}
    ranges: list[tuple[int, int, int, int, int]] = []
    next_bin = 0

    def put(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            open_bins.setdefault(remaining, deque()).append((first, n))
            tree.add(remaining, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining = capacity
                first, n = next_bin, -(-left // (capacity // length))
                next_bin += n
            else:
                first, n = open_bins[remaining].popleft()
                tree.add(remaining, -n)
            # What is left of a bin that took a piece is tighter than any bin
            # of the same size, so it goes on taking pieces of this length.
            per_bin = remaining // length
            full = min(n, left // per_bin)
            if full:
                ranges.append((length, rank, per_bin, first, capacity - remaining))
                put(remaining - per_bin * length, first, full)
                rank, left = rank + full * per_bin, left - full * per_bin
            if full < n and left:
                ranges.append((length, rank, per_bin, first + full, capacity - remaining))
                put(remaining - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            if full < n:
                open_bins.setdefault(remaining, deque()).appendleft((first + full, n - full))
                tree.add(remaining, n - full)
    columns = np.asarray(ranges, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "per_bin", "bin", "offset"), columns))


# ------------------------------------------------------------------- pack
def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0,
         scratch: Scratch | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``.

    A null or empty text is the end id alone; repeated rows are packed each
    (equal rows take places in any order); an empty table gives no rows. The
    driver gets the histogram (at most ``capacity`` rows), and the plan it
    broadcasts holds a few ranges per length, whatever the number of pieces."""
    scratch = scratch or Scratch(df.sparkSession)
    pieces = scratch.table(cut_pieces(df, tokenizer, capacity, end_id))
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}
    plan = best_fit_decreasing(histogram, capacity)
    plan["key"] = (plan["length"] << 44) + plan["first"]
    order = np.argsort(plan["key"])
    shared = df.sparkSession.sparkContext.broadcast({k: v[order] for k, v in plan.items()})

    # As many buckets as a length's pieces need; one row for each length.
    parts = df.sparkSession.createDataFrame(
        [(n, -(-count // rows_per_bucket)) for n, count in histogram.items()],
        "length bigint, parts bigint")
    bucketed = (pieces.join(F.broadcast(parts), "length")
                .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.col("parts")))
                .drop("parts"))
    before = (bucketed.groupBy("length", "bucket").count()
              .withColumn("before", F.sum("count").over(
                  Window.partitionBy("length").orderBy("bucket")
                  .rowsBetween(Window.unboundedPreceding, -1)))
              .select("length", "bucket", F.coalesce("before", F.lit(0)).alias("before")))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (bucketed.withColumn("place", F.row_number().over(within) - 1)
              .join(before, ["length", "bucket"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("place")).alias("rank")))

    def place(part: pa.RecordBatch, _):
        p = shared.value
        column = {n: part.column(i) for i, n in enumerate(part.schema.names)}
        length = column["length"].to_numpy()
        rank = column["rank"].to_numpy()
        at = np.searchsorted(p["key"], (length << 44) + rank, side="right") - 1
        step = rank - p["first"][at]
        return {**column, "sequence_id": p["bin"][at] + step // p["per_bin"][at],
                "offset": p["offset"][at] + step % p["per_bin"][at] * length}

    return map_batches(ranked, place, PIECES + ", sequence_id bigint, offset bigint")
