"""Alignment of two tokenizers' tokens over the same bytes.

Both token lists of a text are turned into ascending lists of byte ends. The
shorter one drives: every end of it gallops (steps of 1, 2, 4, ..., then a
binary search) into the longer one, from the place of an end before it. Ends
found in both lists cut the tokens into groups; the difference between the ranks
of an end and of the one before it is the range of the other list's tokens that
a token overlaps. A slice's texts are worked off together, in numpy.

How often two ids are linked is counted over the whole corpus. A text's distinct
id pairs are kept in a table of the shared folder, so that no text is tokenised
twice. Counts of at most ``TABLE_PAIRS`` pairs, the most frequent ones, are
broadcast; what a text holds of other pairs meets its counts in a join."""
from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch
from .common import map_batches, only
from .packing import encoder
from .token_counts import byte_symbols

TABLE_PAIRS = 1 << 20          # pair counts that are broadcast: 17 bytes each
HELD_PAIRS = 1 << 21           # pairs that a task gathers before it adds them up
STRIDES = (1024, 32, 4, 1)     # an end gallops from the last multiple of the stride before
SPACE = "▁"
TEXTS = ("doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
         "groups_sha256 string, pairs binary, times binary")


# ------------------------------------------------------------- two tokenizers
class Tokenizers:
    """Ids of a byte-level BPE file (A) and of a SentencePiece model (B), and
    the bytes of every id. Strings of special tokens are plain text to both."""

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        self.a = encoder(byte_level).ranks
        with open(byte_level, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        byte = {c: b for b, c in enumerate(byte_symbols())}
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for entry, i in vocab.items():
            self.a_bytes[i] = bytes(map(byte.__getitem__, entry))
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace(SPACE, " ").encode()
                        for i in range(self.b.piece_size()) for p in [self.b.id_to_piece(i)]]
        self.a_length = np.asarray([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_length = np.asarray([len(x) for x in self.b_bytes], dtype=np.int64)
        self.separators = _spelling(max(len(self.a_bytes), len(self.b_bytes)))

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids by A of space + text and by B of text; none where a text is empty
        or either side's bytes are not those of space + text."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1)):
            a = self.a.encode_ordinary(" " + text) if text else []
            raw = b" " + text.encode()
            same = text and b"".join(map(self.a_bytes.__getitem__, a)) == raw \
                and b"".join(map(self.b_bytes.__getitem__, b)) == raw
            out.append((a, b) if same else ([], []))
        return out


def _spelling(ids: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal id and what follows it (``,``, ``|``, ``;`` or nothing) at row
    ``4 * id + kind``, with the number of bytes."""
    texts = [b"%d%s" % (i, mark) for i in range(ids) for mark in (b",", b"|", b";", b"")]
    width = max(map(len, texts))
    flat = np.frombuffer(b"".join(t.ljust(width) for t in texts), dtype=np.uint8)
    return flat.reshape(-1, width), np.asarray([len(t) for t in texts], dtype=np.int64)


_TOKENIZERS: dict[tuple[str, str], Tokenizers] = {}


def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    key = (byte_level, pieces)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = Tokenizers(*key)
    return _TOKENIZERS[key]


# ------------------------------------------------------- galloping intersection
def gallop(targets: np.ndarray, ends: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Index of the first of the ascending ``ends`` that is not below each
    target, searched from ``low`` on; the last end is not below any."""
    low, high = low.copy(), low.copy()
    active, width = np.arange(len(targets)), 1
    while len(active):                             # exponential: steps of 1, 2, 4, ...
        probe = np.minimum(low[active] + (width - 1), len(ends) - 1)
        below = ends[probe] < targets[active]
        high[active[~below]] = probe[~below]
        active = active[below]
        low[active] = probe[below] + 1
        width *= 2
    active = np.flatnonzero(low < high)
    while len(active):                             # binary: within the last step
        middle = (low[active] + high[active]) >> 1
        below = ends[middle] < targets[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return low


def ranks(drive: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rank of every driving end in ``ends``; both ascend and end alike."""
    found = np.zeros(len(drive), dtype=np.int64)
    before = 0
    for stride in STRIDES:
        at = np.arange(0, len(drive), stride)
        if before:
            at = at[at % before != 0]
            start = found[at // before * before]
        else:
            start = np.zeros(len(at), dtype=np.int64)
        found[at] = gallop(drive[at], ends, start)
        before = stride
    return found


class Alignment:
    """Tokens of texts of which the same side is the shorter list, one text
    after the other. ``meets``: the driving tokens that end where another token
    ends, too; ``first`` and ``count``: the range of the other side's tokens
    that each driving token overlaps."""

    def __init__(self, drive_length: np.ndarray, other_length: np.ndarray):
        drive, other = np.cumsum(drive_length), np.cumsum(other_length)
        self.rank = ranks(drive, other)
        self.meets = other[self.rank] == drive
        self.first = np.concatenate([[0], (self.rank + self.meets)[:-1]])
        self.count = self.rank - self.first + 1

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Driving and other token of every overlap."""
        left = np.repeat(np.arange(len(self.count)), self.count)
        lead = np.cumsum(self.count) - self.count
        return left, np.repeat(self.first - lead, self.count) + np.arange(len(left))


def _spell(tok: Tokenizers, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray,
           a_edge: np.ndarray, b_edge: np.ndarray) -> list[str]:
    """sha256 of each text's groups; ``a_last`` and ``b_last`` mark the tokens
    that end a group, the edges hold the texts' first tokens and the totals."""
    a_group = np.concatenate([[0], np.cumsum(a_last)[:-1]])
    b_group = np.concatenate([[0], np.cumsum(b_last)[:-1]])
    a_ends, b_ends = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    # Before a group's A tokens stand all B tokens of earlier groups, before its
    # B tokens all A tokens up to its own.
    codes[np.arange(len(a)) + np.concatenate([[0], b_ends])[a_group]] = 4 * a + a_last
    kind = np.where(b_last, 2, 0)
    kind[b_edge[1:] - 1] = 3
    codes[np.arange(len(b)) + a_ends[b_group]] = 4 * b + kind
    table, length = tok.separators
    rows, sizes = table[codes], length[codes]
    flat = rows[np.arange(table.shape[1]) < sizes[:, None]]
    cut = np.concatenate([[0], np.cumsum(sizes)])[a_edge + b_edge]
    data = memoryview(flat)
    return [hashlib.sha256(data[s:e]).hexdigest() for s, e in zip(cut, cut[1:])]


def align(tok: Tokenizers, texts: list[str]) -> dict[str, list]:
    """Per text the counts of tokens, groups and links, the hash of the groups,
    and the distinct linked id pairs (A id times B's ids plus B id, ascending)
    with how often each is linked."""
    ids = tok.encode(texts)
    out: dict[str, list] = {n: [0] * len(texts) for n in ("n_a", "n_b", "n_groups", "n_links")}
    out |= {"groups_sha256": [""] * len(texts), "pairs": [b""] * len(texts),
            "times": [b""] * len(texts)}
    for a_drives in (True, False):
        held = [i for i, (a, b) in enumerate(ids) if a and (len(a) <= len(b)) == a_drives]
        if not held:
            continue
        a = np.concatenate([np.asarray(ids[i][0], dtype=np.int64) for i in held])
        b = np.concatenate([np.asarray(ids[i][1], dtype=np.int64) for i in held])
        a_edge = np.cumsum([0] + [len(ids[i][0]) for i in held])
        b_edge = np.cumsum([0] + [len(ids[i][1]) for i in held])
        lengths = tok.a_length[a], tok.b_length[b]
        one = Alignment(*(lengths if a_drives else lengths[::-1]))
        edge = a_edge if a_drives else b_edge
        other_last = np.zeros(len(b if a_drives else a), dtype=bool)
        other_last[one.rank[one.meets]] = True
        lasts = (one.meets, other_last) if a_drives else (other_last, one.meets)
        hashes = _spell(tok, a, b, *lasts, a_edge, b_edge)
        groups = np.add.reduceat(one.meets.astype(np.int64), edge[:-1])
        links = np.add.reduceat(one.count, edge[:-1])
        left, right = one.links()
        keys = (a[left] if a_drives else a[right]) * len(tok.b_bytes) \
            + (b[right] if a_drives else b[left])
        stop = np.cumsum(links)
        for k, i in enumerate(held):
            pairs, times = np.unique(keys[stop[k] - links[k]:stop[k]], return_counts=True)
            out["n_a"][i], out["n_b"][i] = len(ids[i][0]), len(ids[i][1])
            out["n_groups"][i], out["n_links"][i] = int(groups[k]), int(links[k])
            out["groups_sha256"][i] = hashes[k]
            out["pairs"][i], out["times"][i] = pairs.tobytes(), times.astype("<u4").tobytes()
    return out


# --------------------------------------------------------------- counted pairs
def _add_up(keys: list, counts: list) -> tuple[np.ndarray, np.ndarray]:
    pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(pairs), dtype=np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return pairs, total


def _unpack(batch: pa.RecordBatch, name: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of packed arrays, and how many each row has."""
    column = batch.column(batch.schema.get_field_index(name)).to_pylist()
    sizes = np.asarray([len(x) for x in column], dtype=np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column), dtype=kind).astype(np.int64), sizes


def _pair_counts(batches):
    keys, counts, held = [], [], 0

    def flush():
        pairs, total = _add_up(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(total)], ["pair", "n"])

    for batch in batches:
        keys.append(_unpack(batch, "pairs", "<i8")[0])
        counts.append(_unpack(batch, "times", "<u4")[0])
        held += len(keys[-1])
        if held > HELD_PAIRS:
            yield flush()
            keys, counts, held = [], [], 0
    if held:
        yield flush()


def pair_counts(texts: DataFrame, b_ids: int) -> DataFrame:
    """``pair, n, best``: how often each id pair is linked in the corpus, and
    whether no pair of the same B id is linked more often."""
    spark = texts.sparkSession
    partial = texts.select("pairs", "times").mapInArrow(
        _pair_counts, spark.createDataFrame([], "pair bigint, n bigint").schema)
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n")) \
        .withColumn("b", F.col("pair") % b_ids)
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _frequent_from(counts: DataFrame, limit: int) -> int:
    """The least power of two such that at most ``limit`` pairs are linked that
    often or more; 1 if that holds for all of them."""
    sizes = dict(map(tuple, counts.groupBy(
        F.floor(F.log2(F.col("n") + F.lit(0.5))).cast("int").alias("power"))
        .agg(F.count(F.lit(1))).collect()))             # at most 64 rows
    total, power = 0, max(sizes, default=-1) + 1
    while power > 0 and total + sizes.get(power - 1, 0) <= limit:
        power -= 1
        total += sizes.get(power, 0)
    return 1 << power


def overlaps(docs: DataFrame, byte_level: str, pieces: str,
             table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``
    per row of ``docs(doc_id, text)``.

    A null or empty text, and one that a tokenizer doesn't give back byte by
    byte, has no tokens: zeros and an empty hash. Rows stand for themselves:
    repeated ones and ones without an id each have a row and count as texts of
    their own. Of pairs with one B id that tie for the highest count all are
    best. An empty table gives no rows; other columns are ignored."""
    spark = docs.sparkSession
    scratch = Scratch(spark)

    def batch(part: pa.RecordBatch, tok: Tokenizers):
        out = align(tok, [t or "" for t in part.column(1).to_pylist()])
        return {"doc_id": part.column(0), **out}

    plain = TEXTS.replace("row bigint, ", "")
    texts = scratch.table(
        map_batches(only(docs, doc_id="bigint", text="string"), batch, plain, text="text",
                    setup=lambda: tokenizers(byte_level, pieces))
        .withColumn("row", F.monotonically_increasing_id()))
    b_ids = len(tokenizers(byte_level, pieces).b_bytes)
    counts = scratch.table(pair_counts(texts, b_ids))
    least = _frequent_from(counts, table_pairs)
    table = counts.where(F.col("n") >= least).toArrow()     # at most table_pairs rows
    order = np.argsort(table["pair"].to_numpy())
    shared = spark.sparkContext.broadcast(tuple(
        table[c].to_numpy(zero_copy_only=False)[order] for c in ("pair", "n", "best")))

    def look_up(part: pa.RecordBatch, known):
        pair, n, best = known
        keys, sizes = _unpack(part, "pairs", "<i8")
        times, _ = _unpack(part, "times", "<u4")
        of = np.repeat(np.arange(part.num_rows), sizes)
        at = np.searchsorted(pair, keys)
        at[at == len(pair)] = 0
        hit = pair[at] == keys if len(pair) else np.zeros(len(keys), dtype=bool)
        here, of_hit, much = at[hit], of[hit], times[hit]
        sums = np.zeros((2, part.num_rows), dtype=np.int64)
        np.add.at(sums[0], of_hit, much * best[here])
        np.add.at(sums[1], of_hit, much * n[here])
        lost = np.bincount(of[~hit], minlength=part.num_rows)
        edge = pa.array(np.concatenate([[0], np.cumsum(lost)]).astype(np.int32))
        rest = pa.StructArray.from_arrays([pa.array(keys[~hit]), pa.array(times[~hit])],
                                          ["pair", "times"])
        out = {f: part.column(part.schema.get_field_index(f))
               for f in ("doc_id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
        return out | {"n_best": sums[0], "count_sum": sums[1],
                      "rest": pa.ListArray.from_arrays(edge, rest)}

    summed = map_batches(
        texts, look_up,
        "doc_id bigint, row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
        "groups_sha256 string, n_best bigint, count_sum bigint, "
        "rest array<struct<pair bigint, times bigint>>", setup=lambda: shared.value)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
               "groups_sha256"]
    if least == 1:                                  # the broadcast table has every pair
        return summed.select(*columns)
    summed = scratch.table(summed)
    rare = (summed.select("row", F.inline("rest"))
            .join(counts.where(F.col("n") < least), "pair")
            .groupBy("row").agg(
                F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return (summed.join(rare, "row", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0)))
            .select(*columns))
