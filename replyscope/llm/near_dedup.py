"""Near-duplicate groups by bottom-k sketches.

A document's set holds the hashes of its distinct word shingles; its sketch is
the ``k`` smallest of them, all from one hash function. Two sets with Jaccard
similarity of at least the threshold share at least ``o`` retained values
(``o`` is exact for sets that fit in the sketch and fails with a probability
under 1e-8 otherwise), so it is enough that they meet among the rarest
``k - o + c`` values of each, ``c`` times.

1. Equal sets collapse to one representative.
2. Inverted lists of the rare retained values generate overlaps. Short lists
   give counted pairs; long lists give one edge per member to the smallest
   member of about its size. Both only say who may be alike: the connected
   components of these edges are the clusters to look into.
3. In a cluster, block by block, the union-sketch estimate drops pairs that
   are too far below the threshold, and exact Jaccard on the full sets verifies
   the rest. A block emits a spanning forest of its links, never all of them.
4. The components of the verified links are the groups."""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import Words, map_batches, mix, only, signed, slices, text_bytes
from .components import connected_components

SKETCH = 48
SURE = 24            # retained values that two near sets share at least
MEETINGS = 3         # rare values that they have to share in short lists
SHORT_LIST = 8
SALTS = 64
BLOCK = 1024
COLUMNS = 4096


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text with fewer words
    than a shingle is one shingle, a text without words has none."""
    raw, offsets = text_bytes(column)
    words = Words(raw, offsets, fold=True)
    at, h = words.windows(size)
    row = words.row[at]
    count = np.diff(words.first)
    for n in range(1, size):
        short = np.flatnonzero(count == n)
        if len(short):
            whole = np.zeros(len(short), dtype=np.uint64)
            for j in range(n):
                whole = mix(whole + words.hash[words.first[short] + j] + np.uint64(n))
            row, h = np.concatenate([row, short]), np.concatenate([h, whole])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    row, h = row[new], h[new]
    return np.split(h, np.searchsorted(row, np.arange(1, len(count))))


def _sketches(docs: DataFrame, size: int) -> DataFrame:
    def batch(part: pa.RecordBatch, _):
        sets = shingle_sets(part.column(1), size)
        n = np.asarray([len(s) for s in sets], dtype=np.int64)
        keys = [(signed(np.add.reduce(mix(s), keepdims=True))[0],
                 signed(np.add.reduce(mix(s ^ np.uint64(0x5851F42D4C957F2D)), keepdims=True))[0])
                for s in sets]
        return {"doc_id": part.column(0), "n_shingles": n, "key1": [a for a, _ in keys],
                "key2": [b for _, b in keys], "sketch": [signed(s[:SKETCH]) for s in sets]}

    return map_batches(docs, batch, "doc_id bigint, n_shingles bigint, key1 bigint, key2 bigint, "
                                    "sketch array<bigint>", text="text")


def _candidates(sketches: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Edges ``a, b`` whose components hold every pair that may be near."""
    reps = (sketches.where("n_shingles > 0 and doc_id is not null")
            .groupBy("key1", "key2", "n_shingles")
            .agg(F.min("doc_id").alias("rep"), F.first("sketch").alias("sketch")))
    rows = scratch.table(reps.select("rep", "n_shingles", F.explode("sketch").alias("value")))
    often = rows.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    # Values are ordered by (df, value); those of df 1 come first and meet
    # nobody, so only their number matters.
    held = F.least(F.col("n_shingles"), F.lit(SKETCH))
    sure = F.least(F.lit(SURE), F.ceil(F.col("n_shingles") * percent / 100))
    meet = F.least(F.lit(MEETINGS), sure)
    prefix = (rows.join(often, "value").groupBy("rep", "n_shingles")
              .agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("values"))
              .withColumn("meet", meet.cast("int"))
              .withColumn("take", (held - sure + meet - (held - F.size("values"))).cast("int"))
              .where("take > 0")
              .select("rep", "n_shingles", "meet",
                      F.explode(F.slice("values", F.lit(1), F.col("take"))).alias("at"))
              .select("rep", "n_shingles", "meet", "at.df", "at.value"))
    prefix = scratch.table(prefix)
    scratch.drop(rows)
    short = prefix.where(F.col("df") <= SHORT_LIST)
    other = short.select("value", F.col("rep").alias("b"), F.col("n_shingles").alias("n"),
                         F.col("meet").alias("m"))
    pairs = (short.join(other, "value").where("rep < b")
             .where(100 * F.least("n", "n_shingles") >= percent * F.greatest("n", "n_shingles"))
             .groupBy(F.col("rep").alias("a"), "b")
             .agg(F.count("*").alias("seen"), F.min(F.least("m", "meet")).alias("need"))
             .where("seen >= need").select("a", "b"))
    # Near sets differ in size by less than one bucket, so each member meets
    # its own bucket and the next in one of two hubs.
    bucket = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent) + 1e-9)
    hubs = (prefix.where(F.col("df") > SHORT_LIST)
            .withColumn("bucket", F.explode(F.array(bucket, bucket + 1)))
            .select("value", "bucket", "rep", F.pmod(F.xxhash64("rep"), F.lit(SALTS)).alias("salt")))
    # A hub may have a large part of all rows, so members meet in salted parts
    # of it, and the smallest members of the parts meet in the hub.
    parts = hubs.groupBy("value", "bucket", "salt").agg(F.min("rep").alias("b"))
    centre = parts.groupBy("value", "bucket").agg(F.min("b").alias("centre"))
    edges = (hubs.join(parts, ["value", "bucket", "salt"]).select(F.col("rep").alias("a"), "b")
             .union(parts.join(centre, ["value", "bucket"])
                    .select(F.col("b").alias("a"), F.col("centre").alias("b"))))
    return pairs.union(edges.where("a != b").distinct())


def _blocks(clusters: DataFrame, sizes: DataFrame, percent: int, block: int,
            scratch: Scratch) -> DataFrame:
    """``rep, task, side``: the block pairs that each representative is in. A
    cluster of up to ``block`` members is one task; a larger one is cut by size
    bucket and hash, and blocks meet within a bucket and with the next one."""
    # Counts are tables, so that a large cluster's members are joined to them
    # over plain shuffles, which split.
    members = scratch.table(clusters.join(sizes, F.col("node") == F.col("rep")).select(
        "rep", F.col("component").alias("cluster"),
        F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent) + 1e-9)
        .alias("bucket")))
    counted = scratch.table(members.groupBy("cluster", "bucket").agg(F.count("*").alias("n")))
    whole = scratch.table(counted.groupBy("cluster").agg(F.sum("n").alias("whole")))
    counted = counted.join(whole, "cluster")
    parts = F.ceil(F.col("n") / block).cast("int")
    near = scratch.table(counted.where(F.col("whole") > block)
                         .select("cluster", "bucket", parts.alias("parts")))
    small = (members.join(whole.where(F.col("whole") <= block), "cluster")
             .select("rep", F.xxhash64("cluster").alias("task"), F.lit(0).alias("side")))
    large = members.join(near, ["cluster", "bucket"])
    mine = F.pmod(F.xxhash64("rep", "bucket"), F.col("parts")).cast("int")
    task = F.xxhash64("cluster", "low", "i", "high", "j").alias("task")
    same = (large.withColumn("mine", mine)
            .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("rep", "cluster", F.col("bucket").alias("low"), F.col("bucket").alias("high"),
                    F.least("mine", "with").alias("i"), F.greatest("mine", "with").alias("j"),
                    F.when(F.col("mine") <= F.col("with"), 1).otherwise(2).alias("side"))
            .withColumn("side", F.when(F.col("i") == F.col("j"), 0).otherwise(F.col("side"))))

    def next_to(step: int) -> DataFrame:
        theirs = near.select("cluster", (F.col("bucket") - step).alias("bucket"),
                             F.col("parts").alias("theirs"))
        out = (large.withColumn("mine", mine).join(theirs, ["cluster", "bucket"])
               .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("theirs") - 1))))
        lower = step == 1
        return out.select(
            "rep", "cluster", (F.col("bucket") - (0 if lower else 1)).alias("low"),
            (F.col("bucket") + (1 if lower else 0)).alias("high"),
            F.col("mine" if lower else "with").alias("i"),
            F.col("with" if lower else "mine").alias("j"), F.lit(1 if lower else 2).alias("side"))

    cut = same.unionByName(next_to(1)).unionByName(next_to(-1))
    return small.union(cut.select("rep", task, "side"))


def near_links(sets: list[np.ndarray], side: np.ndarray, percent: int) \
        -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the near sets. Side 0 meets everyone, 1 meets 2."""
    n = len(sets)
    size = np.asarray([len(s) for s in sets])
    allowed = np.triu((side[:, None] != side[None, :]) | (side[:, None] == 0), 1)
    allowed &= 100 * np.minimum(size[:, None], size) >= percent * np.maximum(size[:, None], size)
    sketch = [s[:SKETCH] for s in sets]
    shared = overlaps(sketch)
    # Up to the smaller of both largest retained values the two sketches hold
    # all of both sets: the estimate is their Jaccard similarity there.
    top = np.asarray([np.uint64(2**64 - 1) if len(s) <= SKETCH else s[SKETCH - 1] for s in sets])
    upto = np.stack([np.searchsorted(s, top, side="right") for s in sketch])
    upto = np.minimum(upto, np.asarray([len(s) for s in sketch])[:, None])
    union = upto + upto.T - shared
    a, b = np.nonzero(allowed & (shared * SKETCH >= SURE * union))
    if len(a) > 4 * n:
        both = overlaps(sets)[a, b]
    else:
        both = np.asarray([len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                           for i, j in zip(a, b)], dtype=np.int64)
    near = 100 * both >= percent * (size[a] + size[b] - both)
    return a[near], b[near]


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Common values of every two sets: products of the incidence matrix, a
    bounded number of columns at a time; values in one set only are left out."""
    n = len(sets)
    out = np.zeros((n, n), dtype=np.int64)
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    values = np.concatenate(sets) if n else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    first = np.ones(len(values), dtype=bool)
    first[1:] = values[1:] != values[:-1]
    column = np.cumsum(first) - 1
    often = np.bincount(column) > 1 if len(column) else np.zeros(0, dtype=bool)
    keep = often[column] if len(column) else often
    column, owner = (np.cumsum(often) - 1)[column[keep]], owner[keep]
    total = np.zeros((n, n), dtype=np.float32)
    width = int(often.sum())
    for start in range(0, width, COLUMNS):
        lo, hi = np.searchsorted(column, [start, start + COLUMNS])
        held = np.zeros((n, min(COLUMNS, width - start)), dtype=np.float32)
        held[owner[lo:hi], column[lo:hi] - start] = 1
        total += held @ held.T
    np.fill_diagonal(total, 0)
    return out + total.astype(np.int64)


def forest(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Each linked member with the smallest id it is connected to."""
    label = np.arange(len(ids))
    rank = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
    label = rank.copy()
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if np.array_equal(before, label):
            break
    by_rank = np.sort(ids)
    return [(int(i), int(by_rank[r])) for i, r in zip(ids, label) if int(by_rank[r]) != int(i)]


def _verified(tasks: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges ``a, b`` between near sets, from the blocks of all clusters."""
    rows = (tasks.join(docs, F.col("rep") == F.col("doc_id")).select("task", "side", "rep", "text")
            .repartition("task").sortWithinPartitions("task"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, members = None, []

        def links():
            if len(members) < 2:
                return pa.RecordBatch.from_pydict({"a": pa.array([], pa.int64()),
                                                   "b": pa.array([], pa.int64())})
            side, ids, sets = zip(*members)
            a, b = near_links(list(sets), np.asarray(side), percent)
            edges = forest(np.asarray(ids), a, b)
            return pa.RecordBatch.from_pydict(
                {"a": pa.array([x for x, _ in edges], pa.int64()),
                 "b": pa.array([y for _, y in edges], pa.int64())})

        # Slices of bounded bytes: what shingling holds at once follows them, not
        # the texts of a whole batch.
        for batch in (part for whole in batches for part in slices(whole, "text")):
            sets = shingle_sets(batch.column(3), size)
            for t, side, rep, s in zip(*(batch.column(i).to_pylist() for i in range(3)), sets):
                if t != task:
                    out = links()
                    if out.num_rows:
                        yield out
                    task, members = t, []
                members.append((side, rep, s))
        out = links()
        if out.num_rows:
            yield out

    return rows.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(df: DataFrame, size: int = 3, percent: int = 85,
                    scratch: Scratch | None = None, block: int = BLOCK) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if ``100 * intersection >= percent * union`` of
    their shingle sets (words lower-cased A-Z). ``component_id`` is the
    smallest id reachable over links; ``kept`` says that it is the row's own.
    A null, empty or wordless text has an empty set and stays alone; a row
    without an id stays alone and is kept; rows that share an id count as one
    document; an empty table gives no rows."""
    scratch = scratch or Scratch(df.sparkSession)
    docs = only(df, doc_id="bigint", text="string")
    sketches = scratch.table(_sketches(docs, size))
    clusters = connected_components(_candidates(sketches, percent, scratch), scratch)
    keys = ["key1", "key2", "n_shingles"]
    members = sketches.where("n_shingles > 0 and doc_id is not null").select("doc_id", *keys)
    classes = members.groupBy(*keys).agg(F.min("doc_id").alias("rep"))
    tasks = _blocks(clusters, classes.select("rep", "n_shingles"), percent, block,
                    scratch)
    links = scratch.table(_verified(tasks, docs, size, percent))
    groups = connected_components(links.select("a", "b"), scratch)
    found = (members.join(classes, keys).join(groups, F.col("rep") == F.col("node"), "left")
             .groupBy("doc_id").agg(F.min(F.coalesce("component", "rep")).alias("component_id")))
    out = (sketches.select("doc_id", "n_shingles").join(found, "doc_id", "left")
           .withColumn("component_id", F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
                      .alias("kept"))
