"""Exact top-k search that skips what can't hold a top-k row.

KB rows are dealt to clusters around seed rows, and a cluster to blocks of a
bounded mean size. Per cluster a bound says how high any of its rows can score
for a query:

- sparse vectors, block-max: the largest weight of every term in the cluster,
  so ``sum(wq * max wd)`` is an upper bound (terms share ``SLOTS`` slots, whose
  largest weight stands for all of them);
- dense vectors, triangle inequality: the range of the angles between the
  cluster's rows and the ``NEAR`` pivots next to it bounds the angle between any
  row and the query from below.

A query is first scored in the clusters of the seeds it is most similar to; the
k-th best score found there is its threshold. Then a copy goes to the blocks of
those clusters only whose bound reaches the threshold. Inside a sparse cell the
bound is taken again, over the block's own rows. Where the bounds of a dense
search leave too much, the KB is streamed past the queries instead (``packs``).

What is broadcast is bounded whatever the number of rows: ``CELLS`` numbers
for the clusters and their seeds. A block that draws more queries than fit a
cell is copied once per cell of queries."""
from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, small
from .packed import slices

# Fixed value: scores are rounded to this many places before ranking so float
# summation order cannot decide a tie; ties then go to the lower id.
RANK_DECIMALS = 9
QUERY_BLOCK = 4096             # queries of a cell
KB_BLOCK = 16384               # mean rows of a block
LEAST_QUERIES = 256
CELL_SCORES = 1 << 20          # query x KB scores held at once, in a cell or with the clusters
CELL_HITS = 1 << 20            # products of two weights held at once in a cell
SLICE_ROWS = 1024              # rows of a batch worked off at once
SLICE_ENTRIES = 1 << 18        # and entries of their vectors
CLUSTER_ROWS = 4096            # rows for which another cluster is worth its bound
MOST_CLUSTERS = 1024
SLOTS = 4096
CELLS = MOST_CLUSTERS * SLOTS  # doubles of the largest table that is broadcast
NEAR = 16
PROBES = 2                     # clusters that give a query its threshold
MOST_COPIES = 2                # dense copies that are written, per row of either side
SLACK = 1e-8                   # far above rounding, so that no tie is skipped
ANGLE_SLACK = 1e-7             # an arc cosine near 1 keeps half of the digits

SPARSE = "array<struct<term:bigint,w:double>>"
DENSE = "array<double>"


def best_columns(scores: np.ndarray, k: int) -> np.ndarray:
    """Per row the columns of the ``k`` best by (score desc, column asc), best
    first. Only columns that reach the k-th best score are sorted."""
    k = min(k, scores.shape[1])
    if k < scores.shape[1]:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        # Of the columns tied with the k-th best the first ones stand.
        above = scores > least
        tied = scores == least
        keep = above | tied & (np.cumsum(tied, axis=1) <= k - above.sum(axis=1, keepdims=True))
        columns = np.nonzero(keep)[1].reshape(len(scores), k)
    else:
        columns = np.tile(np.arange(k), (len(scores), 1))
    picked = np.take_along_axis(scores, columns, axis=1)
    order = np.argsort(-picked, axis=1, kind="stable")
    return np.take_along_axis(columns, order, axis=1)


# --------------------------------------------------------------- batches of rows
class SparseRows:
    """Terms, row numbers and weights of all entries of a column of vectors."""

    def __init__(self, column: pa.Array):
        column = _chunk(column)
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten()
        self.n = len(sizes)
        self.term = flat.field(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.w = flat.field(1).to_numpy(zero_copy_only=False).astype(np.float64)
        self.row = np.repeat(np.arange(self.n), sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)])

    def slots(self) -> np.ndarray:
        return self.term % SLOTS                # non-negative in numpy

    def against(self, matrix: np.ndarray) -> np.ndarray:
        """Products with the rows of a (clusters x slots) matrix."""
        out = np.zeros((self.n, len(matrix)))
        columns, at = np.ascontiguousarray(matrix.T), self.slots()
        for i in range(self.n):
            s, e = self.first[i], self.first[i + 1]
            if e > s:
                out[i] = self.w[s:e] @ columns[at[s:e]]
        return out


def dense_rows(column: pa.Array) -> np.ndarray:
    column = _chunk(column)
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) \
        .reshape(len(column), -1)


def _chunk(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


# -------------------------------------------------------------------- clusters
@dataclass
class Clusters:
    """Seeds, sizes and bounds of the clusters; ``first`` is the number of each
    cluster's first block, ``blocks`` how many it has."""

    kind: str
    seeds: np.ndarray                       # clusters x slots, or x dimensions
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    first: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    blocks: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    peaks: np.ndarray | None = None         # sparse: largest weights, clusters x slots
    near: np.ndarray | None = None          # dense: pivots next to each cluster
    low: np.ndarray | None = None           # and the angles its rows have with them
    high: np.ndarray | None = None
    norms: np.ndarray | None = None         # least and largest norm per cluster

    def __len__(self) -> int:
        return len(self.seeds)

    @property
    def total_blocks(self) -> int:
        return int(self.blocks.sum())

    def affinity(self, column: pa.Array) -> np.ndarray:
        if self.kind == SPARSE:
            return SparseRows(column).against(self.seeds)
        return np.cos(angles(dense_rows(column), self.seeds))

    def upper(self, column: pa.Array) -> np.ndarray:
        """Upper bound of the score of each row with any row of each cluster;
        minus infinity for an empty cluster."""
        if self.kind == SPARSE:
            bound = SparseRows(column).against(self.peaks)
        else:
            rows = dense_rows(column)
            angle = angles(rows, self.seeds)
            apart = np.zeros((len(rows), len(self)))
            for j in range(self.near.shape[1]):
                a = angle[:, self.near[:, j]]
                apart = np.maximum(apart, np.maximum(a - self.high[:, j], self.low[:, j] - a))
            cosine = np.cos(np.clip(apart - ANGLE_SLACK, 0.0, np.pi))
            # The norm that makes the most of the cosine, whatever its sign.
            norm = np.where(cosine >= 0, self.norms[:, 1], self.norms[:, 0])
            bound = np.linalg.norm(rows, axis=1, keepdims=True) * norm * cosine
        return np.where(self.sizes > 0, bound, -np.inf)


def angles(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Angles between rows and pivots; a right angle where one is zero."""
    scale = np.linalg.norm(rows, axis=1, keepdims=True) * np.linalg.norm(pivots, axis=1)
    product = rows @ pivots.T if rows.size else np.zeros((len(rows), len(pivots)))
    return np.arccos(np.clip(np.divide(product, scale, out=np.zeros_like(product),
                                       where=scale > 0), -1.0, 1.0))


def _sliced(batch: pa.RecordBatch, at: int, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose column ``at`` has vectors: what is made of the
    rows at once doesn't follow the size of the batch."""
    sizes = np.diff(_chunk(batch.column(at)).offsets.to_numpy())
    for start, stop in slices(sizes, entries=SLICE_ENTRIES, rows=rows):
        yield batch.slice(start, stop - start)


def _map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str,
         at: int, clusters: int) -> DataFrame:
    """``mapInArrow`` in slices of rows that are compared with ``clusters``;
    column ``at`` has the vectors."""
    rows = max(1, min(SLICE_ROWS, CELL_SCORES // max(1, clusters)))

    def run(batches):
        for batch in batches:
            for part in _sliced(batch, at, rows):
                yield from fn(part)
    return df.mapInArrow(run, schema)


def seed_rows(kb: DataFrame, kind: str, cluster_rows: int = CLUSTER_ROWS) -> Clusters:
    """Clusters around rows drawn by a hash of their id, at most
    ``MOST_CLUSTERS`` of them (fewer if the vectors are very wide)."""
    n = kb.count()
    wanted = int(min(MOST_CLUSTERS, max(1, -(-n // cluster_rows))))
    usable = kb.where(F.size("vec") > 0)
    if kind == DENSE:
        width = usable.agg(F.max(F.size("vec"))).first()[0] or 1
        wanted = max(1, min(wanted, CELLS // width))
    drawn = usable.orderBy(F.xxhash64("id"), "id").limit(wanted).select("vec").toArrow()
    column = _chunk(drawn["vec"])
    if kind == DENSE:
        seeds = dense_rows(column)
        return Clusters(kind, seeds if len(seeds) else np.zeros((1, 1)))
    rows = SparseRows(column)
    seeds = np.zeros((max(rows.n, 1), SLOTS), order="F")      # read by slot
    np.add.at(seeds, (rows.row, rows.slots()), rows.w)
    return Clusters(kind, seeds)


def assign(kb: DataFrame, clusters: Clusters) -> DataFrame:
    """``id, vec, cluster``: each row goes to the seed most like it."""
    shared = kb.sparkSession.sparkContext.broadcast(clusters)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        home = shared.value.affinity(batch.column(1)).argmax(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(home.astype(np.int32))],
            ["id", "vec", "cluster"])

    return _map(kb.select("id", "vec"), run, f"id bigint, vec {clusters.kind}, cluster int",
                1, len(clusters))


def measure(assigned: DataFrame, clusters: Clusters, kb_block: int = KB_BLOCK) -> Clusters:
    """Sizes, blocks and bounds of the clusters of ``assigned``."""
    c = len(clusters)
    sizes = np.zeros(c, dtype=np.int64)
    for r in assigned.groupBy("cluster").count().collect():         # at most c rows
        sizes[r[0]] = r[1]
    blocks = np.maximum(-(-sizes // kb_block), 1)
    out = Clusters(clusters.kind, clusters.seeds, sizes, np.cumsum(blocks) - blocks, blocks)
    if c <= PROBES:                         # every cluster is searched
        return out
    bounds(assigned, out)
    return out


def bounds(assigned: DataFrame, out: Clusters) -> None:
    """Set the bounds of the clusters from their rows."""
    c = len(out)
    if out.kind == SPARSE:
        entries = assigned.select("cluster", F.inline("vec"))
        top = entries.groupBy("cluster", F.pmod("term", F.lit(SLOTS)).cast("int").alias("slot")) \
            .agg(F.max("w").alias("w")).toArrow()                   # at most CELLS rows
        out.peaks = np.zeros((c, SLOTS), order="F")
        out.peaks[top["cluster"].to_numpy(), top["slot"].to_numpy()] = top["w"].to_numpy()
        return
    pivots = out.seeds
    out.near = np.argsort(angles(pivots, pivots), axis=1, kind="stable")[:, :NEAR]
    width = out.near.shape[1]
    out.low, out.high = np.full((c, width), np.inf), np.full((c, width), -np.inf)
    out.norms = np.stack([np.full(c, np.inf), np.full(c, -np.inf)], axis=1)
    near = out.near

    def ranges(batches):
        # Per task one row per cluster and pivot next to it; place -1 has norms.
        low, high = np.full((c, width + 1), np.inf), np.full((c, width + 1), -np.inf)
        step = max(1, min(SLICE_ROWS, CELL_SCORES // c))
        for batch in (part for whole in batches for part in _sliced(whole, 0, step)):
            rows, home = dense_rows(batch.column(0)), batch.column(1).to_numpy()
            angle = np.take_along_axis(angles(rows, pivots), near[home], axis=1)
            held = np.column_stack([angle, np.linalg.norm(rows, axis=1)])
            np.minimum.at(low, home, held)
            np.maximum.at(high, home, held)
        some, place = np.nonzero(np.isfinite(low))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some.astype(np.int32)), pa.array(place.astype(np.int32)),
             pa.array(low[some, place]), pa.array(high[some, place])],
            ["cluster", "place", "low", "high"])

    found = assigned.select("vec", "cluster").mapInArrow(
        ranges, "cluster int, place int, low double, high double").groupBy("cluster", "place") \
        .agg(F.min("low").alias("low"), F.max("high").alias("high")).toArrow()
    at = found["cluster"].to_numpy(), found["place"].to_numpy()
    low, high = np.full((c, width + 1), np.inf), np.full((c, width + 1), -np.inf)
    low[at], high[at] = found["low"].to_numpy(), found["high"].to_numpy()
    out.low, out.high = low[:, :width], high[:, :width]
    out.norms = np.stack([low[:, width], high[:, width]], axis=1)


def widened(clusters: Clusters, more: Clusters) -> Clusters:
    """The clusters with further rows: ``more`` has their sizes and bounds."""
    out = replace(clusters, sizes=clusters.sizes + more.sizes)
    if clusters.peaks is not None:
        out.peaks = np.maximum(clusters.peaks, more.peaks)
    if clusters.near is not None:
        out.low, out.high = np.minimum(clusters.low, more.low), np.maximum(clusters.high, more.high)
        out.norms = np.stack([np.minimum(clusters.norms[:, 0], more.norms[:, 0]),
                              np.maximum(clusters.norms[:, 1], more.norms[:, 1])], axis=1)
    return out


def into_blocks(assigned: DataFrame, clusters: Clusters) -> DataFrame:
    """``block, id, vec``."""
    table = assigned.sparkSession.createDataFrame(
        [(i, int(f), int(b)) for i, (f, b) in enumerate(zip(clusters.first, clusters.blocks))],
        "cluster int, first int, parts int")
    return assigned.join(F.broadcast(table), "cluster").select(
        (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int").alias("block"),
        "id", "vec")


def build(kb: DataFrame, kind: str, kb_block: int = KB_BLOCK,
          cluster_rows: int = CLUSTER_ROWS) -> tuple[DataFrame, Clusters]:
    """Blocks ``(block, id, vec)`` and clusters of ``kb(id, vec)``, a table.
    Sparse rows without a term score 0 with anything and are in no block."""
    held = kb.where(F.size("vec") > 0)
    clusters = seed_rows(held, kind, cluster_rows)
    if len(clusters) == 1:
        assigned = held.select("id", "vec", F.lit(0).alias("cluster"))
    else:
        assigned = Scratch.of(kb.sparkSession).table(assign(held, clusters))
    clusters = measure(assigned, clusters, kb_block)
    return into_blocks(assigned, clusters), clusters


# ------------------------------------------------------------------------ cells
def _scored(kind: str, k: int, exclude_self: bool):
    """A cell: the k best rows of a block for each query. Sparse rows that
    share nothing with a query are left out."""
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows and k > 0):
            return schema.empty_table()
        ids = right["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, vecs = ids[order], _chunk(right["vec"]).take(pa.array(order))
        del right
        row = left["row"].to_numpy()
        own = left["self_id"].to_pylist()
        own_id = np.asarray([0 if v is None else v for v in own], dtype=np.int64)
        has_id = np.asarray([v is not None for v in own])
        least = left["least"].to_numpy()
        scores_of = _sparse_scores if kind == SPARSE else _dense_scores
        out = []
        for at, held, scores in scores_of(_chunk(left["vec"]), vecs, least):
            keyed = np.round(scores, RANK_DECIMALS)
            if exclude_self:
                keyed[(own_id[at, None] == ids[held]) & has_id[at, None]] = -np.inf
            columns = best_columns(keyed, k)
            rows = np.repeat(np.arange(len(at)), columns.shape[1])
            columns = columns.ravel()
            value = keyed[rows, columns]
            stays = value > 0 if kind == SPARSE else np.isfinite(value)
            rows, columns = rows[stays], columns[stays]
            out.append((at[rows], ids[held][columns], scores[rows, columns]))
        if not out:
            return schema.empty_table()
        at, found, scores = (np.concatenate(c) for c in zip(*out))
        # A query has k rows of every slice of the block; k of all of them stay.
        order = np.lexsort((found, -np.round(scores, RANK_DECIMALS), at))
        mine = at[order]
        order = order[np.arange(len(mine)) - np.searchsorted(mine, mine, "left") < k]
        return pa.Table.from_arrays([pa.array(row[at[order]]), pa.array(found[order]),
                                     pa.array(scores[order])], schema=schema)
    return run


def _sparse_scores(left: pa.Array, right: pa.Array, least: np.ndarray):
    """Queries, range of the KB rows and scores, slice by slice of both sides.
    Queries whose bound over a slice of the KB rows doesn't reach their
    threshold are left out of it."""
    queries = list(slices(np.diff(left.offsets.to_numpy()), entries=SLICE_ENTRIES))
    for first, end in slices(np.diff(right.offsets.to_numpy()), entries=SLICE_ENTRIES):
        d = SparseRows(right.slice(first, end - first))
        order = np.argsort(d.term, kind="stable")
        term, doc, wd = d.term[order], d.row[order], d.w[order]
        lead = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else []
        peak = np.zeros(len(term) + 1)
        if len(term):
            peak[lead] = np.maximum.reduceat(wd, lead)
        for base, stop in queries:
            q = SparseRows(left.slice(base, stop - base))
            low = np.searchsorted(term, q.term, "left")
            meets = np.searchsorted(term, q.term, "right") - low
            bound = np.bincount(q.row, q.w * np.where(meets > 0, peak[low], 0.0), minlength=q.n)
            chosen = np.flatnonzero((bound > 0) & (bound + SLACK >= least[base:stop]))
            hits = np.bincount(q.row, meets, minlength=q.n)[chosen].astype(np.int64)
            for start, until in slices(hits, entries=CELL_HITS, rows=max(1, CELL_SCORES // d.n)):
                at = chosen[start:until]
                yield base + at, slice(first, end), _products(q, at, low, meets, doc, wd, d.n)


def _products(q: SparseRows, at: np.ndarray, low: np.ndarray, meets: np.ndarray, doc: np.ndarray,
              wd: np.ndarray, n: int) -> np.ndarray:
    """Scores of the queries ``at`` with ``n`` rows, whose entries ``doc, wd``
    hold an entry's term ``meets`` times from ``low`` on."""
    place = np.full(q.n, -1)
    place[at] = np.arange(len(at))
    base = q.first[at[0]]
    mine = base + np.flatnonzero(place[q.row[base:q.first[at[-1] + 1]]] >= 0)
    many = meets[mine]
    hit = np.repeat(low[mine] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    cell = np.repeat(place[q.row[mine]] * n, many) + doc[hit]
    scores = np.bincount(cell, np.repeat(q.w[mine], many) * wd[hit], minlength=len(at) * n)
    return scores.astype(np.float64).reshape(-1, n)             # integers if none meet


def _dense_scores(left: pa.Array, right: pa.Array, least: np.ndarray):
    q, d = dense_rows(left), dense_rows(right)
    step = max(1, CELL_SCORES // len(d))
    for start in range(0, len(q), step):
        yield np.arange(start, min(start + step, len(q))), slice(0, len(d)), \
            q[start:start + step] @ d.T


def _cells(copies: DataFrame, kb_blocks: DataFrame, clusters: Clusters, k: int,
           exclude_self: bool, query_block: int) -> DataFrame:
    """Candidates of ``copies(row, self_id, vec, least, block)``, a table. Where
    a block's queries fit a cell the KB side is grouped by block alone, so a
    table bucketed by it isn't moved; a crowded block is copied per cell."""
    spark = copies.sparkSession
    cell = _scored(clusters.kind, k, exclude_self)
    out = "row bigint, id bigint, score double"
    load = Scratch.of(spark).table(copies.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
                                   .withColumn("parts", F.ceil(F.col("n") / query_block).cast("int")))
    hint = F.broadcast if small(clusters.total_blocks) else (lambda df: df)
    calm, crowded = load.where("parts = 1").select("block"), load.where("parts > 1")
    found = []
    if not calm.isEmpty():
        left = copies.join(hint(calm), "block", "left_semi")
        right = kb_blocks.join(hint(calm), "block", "left_semi")
        found.append(left.groupBy("block").cogroup(right.groupBy("block"))
                     .applyInArrow(lambda l, r: cell(l, r), out))
    if not crowded.isEmpty():
        parts = crowded.select("block", "parts")
        left = copies.join(hint(parts), "block").withColumn(
            "part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("parts")
        right = kb_blocks.join(hint(parts), "block").withColumn(
            "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        found.append(left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
                     .applyInArrow(lambda l, r: cell(l, r), out))
    if not found:
        return spark.createDataFrame([], out)
    return found[0] if len(found) == 1 else found[0].union(found[1])


# ----------------------------------------------------------------------- search
COPIES = "row bigint, self_id bigint, vec {kind}, least double, block int"


def copied(batch: pa.RecordBatch, known: Clusters, choose: Callable,
           keep: Callable | None = None) -> Iterator[pa.RecordBatch]:
    """The copies of a slice of queries, in batches of bounded vectors: those of
    a few rows can be many times their own size. ``keep`` says which of the
    (query, cluster, block) stay."""
    vec = batch.column(2)
    floor = batch.column(3).to_numpy(zero_copy_only=False)
    at, cluster = np.nonzero(choose(known, vec, floor))
    many = known.blocks[cluster]
    lead = np.cumsum(many) - many
    block = np.repeat(known.first[cluster] - lead, many) + np.arange(int(many.sum()))
    pick = np.repeat(at, many)
    if keep is not None:
        stays = keep(known, vec, batch.column(0).to_numpy(), pick, np.repeat(cluster, many), block)
        pick, block = pick[stays], block[stays]
    sizes = np.diff(_chunk(vec).offsets.to_numpy())[pick]
    for start, stop in slices(sizes, entries=SLICE_ENTRIES):
        part = pa.array(pick[start:stop])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(part), batch.column(1).take(part), vec.take(part),
             batch.column(3).take(part), pa.array(block[start:stop].astype(np.int32))],
            ["row", "self_id", "vec", "least", "block"])


def _copies(queries: DataFrame, clusters: Clusters, choose: Callable,
            keep: Callable | None = None) -> DataFrame:
    """One copy of a query per block of each cluster that ``choose`` gives, of
    those that ``keep`` leaves."""
    shared = queries.sparkSession.sparkContext.broadcast(clusters)
    return _map(queries.select("row", "self_id", "vec", "least"),
                lambda batch: copied(batch, shared.value, choose, keep),
                COPIES.format(kind=clusters.kind), 2, max(len(clusters), clusters.total_blocks))


def _too_many(queries: DataFrame, n: int, clusters: Clusters, choose: Callable) -> bool:
    """Whether the copies of the ``n`` queries would be more than ``MOST_COPIES``
    of all rows of both sides."""
    most = MOST_COPIES * (n + int(clusters.sizes.sum()))
    if n * clusters.total_blocks <= most:
        return False
    shared = queries.sparkSession.sparkContext.broadcast(clusters)

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        known = shared.value
        chosen = choose(known, batch.column(0), batch.column(1).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([pa.array([int((chosen @ known.blocks).sum())])], ["n"])

    made = _map(queries.select("vec", "least"), count, "n bigint", 0, len(clusters))
    return (made.agg(F.sum("n")).first()[0] or 0) > most


def _probed(clusters: Clusters, vec: pa.Array, k: int) -> np.ndarray:
    """The clusters whose seeds are most like each row: ``PROBES``, and as many
    as it takes to hold k rows besides its own, in the blocks that are searched."""
    order = np.argsort(-np.where(clusters.sizes > 0, clusters.affinity(vec), -np.inf), axis=1,
                       kind="stable")
    sizes = clusters.sizes // clusters.blocks if one_block(clusters) else clusters.sizes
    held = np.cumsum(sizes[order], axis=1) - sizes[order]
    taken = (held < k + 1) | (np.arange(len(clusters)) < PROBES)
    out = np.zeros(taken.shape, dtype=bool)
    np.put_along_axis(out, order, taken, axis=1)
    return out & (clusters.sizes > 0)


def one_block(clusters: Clusters) -> bool:
    """Whether a query probes one block of a cluster. However many rows are alike,
    it has few copies then; the cluster's other blocks are for the second look."""
    return clusters.kind == DENSE and len(clusters) > PROBES


def own_block(clusters: Clusters, row: np.ndarray, cluster: np.ndarray | int) -> np.ndarray:
    """The block of a cluster that the query ``row`` probes."""
    return clusters.first[cluster] + row % clusters.blocks[cluster]


def _in_question(clusters: Clusters, vec: pa.Array) -> np.ndarray:
    """Queries that can score at all: those with a vector other than zero."""
    if clusters.kind == SPARSE:
        return np.diff(_chunk(vec).offsets.to_numpy()) > 0
    rows = dense_rows(vec)
    return np.abs(rows).sum(axis=1) > 0 if rows.size else np.zeros(len(rows), dtype=bool)


@dataclass
class Search:
    """``top(row, rank, id, score)`` and the query copies that were scored, for a
    look at the work done: tables, or a frame that nothing has been run for
    where the KB was streamed past the queries."""

    top: DataFrame
    copies: list[DataFrame]
    clusters: Clusters

    def scored_pairs(self) -> int:
        """Query x KB pairs of all cells that were looked into."""
        mean = self.clusters.sizes / np.maximum(self.clusters.blocks, 1)
        rows = np.repeat(mean, self.clusters.blocks)
        return int(sum(r["n"] * rows[r["block"]] for c in self.copies
                       for r in c.groupBy("block").agg(F.count(F.lit(1)).alias("n")).collect()))


def search(queries: DataFrame, kb_blocks: list[DataFrame], ids: DataFrame, clusters: Clusters,
           k: int, exclude_self: bool = True, query_block: int = QUERY_BLOCK) -> Search:
    """For every row of ``queries(row, self_id, vec, ...)``, a table with unique
    ``row`` whose other columns come along, the k best rows of ``kb_blocks(block, id, vec)`` (one frame, or one
    per part of an index) by (rounded score desc, id asc). ``ids(id)`` are all
    KB rows: those that score 0 fill up the ranks in id order. A row never gets
    the KB row ``self_id`` when ``exclude_self``; a null ``self_id`` is none."""
    spark = queries.sparkSession
    scratch = Scratch.of(spark)
    cores = spark.sparkContext.defaultParallelism
    n = queries.count()
    query_block = max(1, min(query_block, max(LEAST_QUERIES, -(-n // cores))))
    start = queries.select("row", "self_id", "vec", F.lit(float("-inf")).alias("least"))

    def cells(copies: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, [
            _cells(copies, part, clusters, k, exclude_self, query_block) for part in kb_blocks])

    if not clusters.sizes.sum():            # no row has anything to compare
        nothing = spark.createDataFrame([], "row bigint, id bigint, score double")
        return Search(_ranked(queries, nothing, ids, k, exclude_self), [], clusters)

    def probe(known: Clusters, vec, _):
        return _probed(known, vec, k) & _in_question(known, vec)[:, None]

    def probed_block(known: Clusters, vec, row, at, cluster, block):
        return block == own_block(known, row[at], cluster)

    first = scratch.table(_copies(start, clusters, probe,
                                  probed_block if one_block(clusters) else None))
    found = scratch.table(cells(first))
    copies = [first]
    if len(clusters) > PROBES:
        ranked = Window.partitionBy("row").orderBy(*rank_order())
        least = (found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k)
                 .select("row", F.round("score", RANK_DECIMALS).alias("reached"),
                         F.col("id").alias("last")))
        floor = F.lit(0.0) if clusters.kind == SPARSE else F.lit(float("-inf"))
        again = start.drop("least").join(least, "row", "left") \
            .select("row", "self_id", "vec", F.coalesce("reached", floor).alias("least"), "last")

        def rest(known: Clusters, vec, reached):
            bound = known.upper(vec)
            alive = bound + SLACK >= reached[:, None]
            if known.kind == SPARSE:
                alive &= bound > 0
            done = _probed(known, vec, k)
            if one_block(known):
                done &= known.blocks == 1
            return alive & ~done & _in_question(known, vec)[:, None] & (known.sizes > 0)

        def other_block(known: Clusters, vec, row, at, cluster, block):
            return ~(_probed(known, vec, k)[at, cluster]
                     & probed_block(known, vec, row, at, cluster, block))

        second = _copies(again, clusters, rest, other_block if one_block(clusters) else None)
        if clusters.kind == DENSE and k > 0 and _too_many(again, n, clusters, rest):
            from .packs import streamed
            whole = reduce(DataFrame.unionByName,
                           [part.select("block", "id", "vec") for part in kb_blocks])
            found = found.union(streamed(again, n, whole, clusters, k, exclude_self, rest, probe))
        else:
            second = scratch.table(second)
            found = found.union(cells(second))
        copies.append(second)
    return Search(_ranked(queries, found, ids, k, exclude_self), copies, clusters)


def rank_order(score_col: str = "score", id_col: str = "id"):
    return [F.round(F.col(score_col), RANK_DECIMALS).desc(), F.col(id_col).asc()]


def _ranked(queries: DataFrame, found: DataFrame, ids: DataFrame, k: int,
            exclude_self: bool) -> DataFrame:
    """The k best candidates of each query, filled up with the lowest ids that
    are none of them: at most k - 1 candidates and the query's own row can stand
    before the k ids needed, so the 2k lowest are enough."""
    low = [r[0] for r in ids.select("id").orderBy("id").limit(2 * k).collect()]
    w = Window.partitionBy("row").orderBy(*rank_order())
    best = (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score")))
                                .alias("best")))
    none = F.array().cast("array<struct<rank:int,id:bigint,score:double>>")
    held = queries.drop("vec").join(best, "row", "left") \
        .withColumn("best", F.coalesce("best", none))
    pads = F.array(*[F.lit(i).cast("bigint") for i in low]).cast("array<bigint>")
    own = F.col("self_id") if exclude_self else F.lit(None).cast("bigint")
    open_ids = F.filter(F.array_except(pads, F.col("best")["id"]),
                        lambda i: ~i.eqNullSafe(own))
    filled = F.concat(
        F.transform("best", lambda b: F.struct(b["id"].alias("id"), b["score"].alias("score"))),
        F.transform(F.slice(open_ids, 1, F.greatest(F.lit(k) - F.size("best"), F.lit(0))),
                    lambda i: F.struct(i.alias("id"), F.lit(0.0).alias("score"))))
    carried = [c for c in queries.columns if c not in ("self_id", "vec")]
    return (held.select(*carried, F.posexplode(filled).alias("at", "hit"))
            .select(*carried, (F.col("at") + 1).alias("rank"), "hit.id", "hit.score"))
