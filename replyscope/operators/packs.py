"""The second look of a dense search without a copy of a query per block.

Where the bounds leave most queries most of the clusters, the copies would grow
with queries x clusters. Here either side is written once, as packs of at most
about ``PACK_BYTES`` of vectors, and a task streams the packs of the KB past one
pack of queries, of which it keeps the k best rows so far. So what is written
grows with the rows, and a task holds two packs and the k best rows.

A pack of queries says which clusters may hold a row for which of them; only
those rows are scored, without the block that a query has probed. What a query has
found so far raises its threshold. Scores are first taken in single precision,
whose error is bounded; those that may reach the threshold are taken again in
double precision."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import small
from .pruned import (CELL_SCORES, RANK_DECIMALS, SLACK, SLICE_ROWS, Clusters, _sliced, dense_rows,
                     own_block)

PACK_BYTES = 8 << 20           # vectors of a pack
TASKS_PER_CORE = 8
SLAB = 512                     # rows of either side that are scored at once
MERGE_HITS = 1 << 16           # candidates that are held before the best are kept
PAIR_NUMBERS = 1 << 19         # numbers of the pairs that are scored one by one

QUERIES = pa.schema([("row", pa.list_(pa.int64())), ("own", pa.list_(pa.int64())),
                     ("least", pa.list_(pa.float64())), ("last", pa.list_(pa.int64())),
                     ("q", pa.binary()), ("alive", pa.binary()), ("probed", pa.binary())])
ROWS = pa.schema([("share", pa.int32()), ("cluster", pa.list_(pa.int32())),
                  ("block", pa.list_(pa.int32())), ("id", pa.list_(pa.int64())),
                  ("d", pa.binary())])
OUT = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
LARGE = 1e15                   # lengths whose products don't overflow in single precision
NO_ID = np.iinfo(np.int64).max


def _list(parts: list[pa.Array]) -> pa.Array:
    """All values of ``parts`` as one list."""
    values = pa.concat_arrays(parts)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _bytes(matrix: np.ndarray) -> pa.Array:
    return pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary())


# ----------------------------------------------------------------------- packs
def query_packs(queries: DataFrame, n: int, clusters: Clusters,
                choose: Callable, probe: Callable) -> tuple[DataFrame, int]:
    """One pack per partition of ``queries(row, self_id, vec, least, last)``, ``n``
    of them: those for which ``choose`` leaves a cluster, these clusters, and
    those that they probed. With it the number of partitions."""
    parts = max(1, -(-n * clusters.seeds.shape[1] * 8 // PACK_BYTES))
    shared = queries.sparkSession.sparkContext.broadcast(clusters)
    step = max(1, min(SLICE_ROWS, CELL_SCORES // max(1, len(clusters))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, q, alive, probed = [], [], [], []
        for part in (p for batch in batches for p in _sliced(batch, 2, step)):
            known, vec = shared.value, part.column(2)
            least = part.column(3).to_numpy(zero_copy_only=False)
            chosen = choose(known, vec, least)
            some = np.flatnonzero(chosen.any(axis=1))
            if len(some):
                held.append([part.column(i).take(pa.array(some)) for i in (0, 1, 3, 4)])
                q.append(dense_rows(vec)[some])
                alive.append(np.packbits(chosen[some], axis=1))
                probed.append(np.packbits(probe(known, vec, least)[some], axis=1))
        if held:
            yield pa.RecordBatch.from_arrays(
                [*(_list(list(c)) for c in zip(*held)),
                 *(_bytes(np.concatenate(c)) for c in (q, alive, probed))], schema=QUERIES)

    dealt = queries.select("row", "self_id", "vec", "least", "last") \
        .repartitionById(parts, F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    return dealt.mapInArrow(run, "row array<bigint>, own array<bigint>, least array<double>, "
                                 "last array<bigint>, q binary, alive binary, probed binary"), parts


def shares(clusters: Clusters) -> tuple[list[tuple[int, int, int]], int]:
    """``(block, cluster, share)`` of the blocks with rows, and the number of
    shares: neighbouring blocks with about a pack of rows make one."""
    cluster = np.repeat(np.arange(len(clusters)), clusters.blocks)
    rows = (clusters.sizes / np.maximum(clusters.blocks, 1))[cluster]
    block = np.flatnonzero(rows > 0)
    before = np.cumsum(rows[block]) - rows[block] / 2
    share = np.unique(before * clusters.seeds.shape[1] * 8 // PACK_BYTES, return_inverse=True)[1]
    return [(int(b), int(cluster[b]), int(s)) for b, s in zip(block, share)], int(share.max()) + 1


def kb_packs(kb_blocks: DataFrame, clusters: Clusters) -> tuple[DataFrame, int]:
    """``kb_blocks(block, id, vec)`` as packs in order of (block, id), and the
    number of shares they are made of."""
    table, n = shares(clusters)
    places = kb_blocks.sparkSession.createDataFrame(table, "block int, cluster int, share int")
    hint = F.broadcast if small(len(table)) else (lambda df: df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in (p for batch in batches for p in _sliced(batch, 4, SLICE_ROWS)):
            # A null id isn't allowed, as in the cells.
            part.column(3).to_numpy()
            held.append(part)
            size += dense_rows(part.column(4)).nbytes
            if size >= PACK_BYTES:
                yield pack(held)
                held, size = [], 0
        if held:
            yield pack(held)

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [held[0].column(0).slice(0, 1),
             *(_list([p.column(i) for p in held]) for i in (1, 2, 3)),
             _bytes(np.concatenate([dense_rows(p.column(4)) for p in held]))], schema=ROWS)

    dealt = kb_blocks.join(hint(places), "block").select("share", "cluster", "block", "id", "vec") \
        .repartitionById(n, "share").sortWithinPartitions("share", "block", "id")
    return dealt.mapInArrow(run, "share int, cluster array<int>, block array<int>, "
                                 "id array<bigint>, d binary"), n


# --------------------------------------------------------------------- scoring
def single(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows in single precision, and a number for each: the product of those of
    two rows is above the error of their score. Rows that might overflow have no
    such bound."""
    with np.errstate(over="ignore"):
        rough = rows.astype(np.float32)
    norm = np.linalg.norm(rows, axis=1)
    unit = np.finfo(np.float32).eps * (rows.shape[1] + 8)
    return rough, np.where(norm < LARGE, norm * np.sqrt(unit), np.inf)


def places(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns that are set, of a mask with few of them."""
    flat = mask.ravel()
    words = flat[:len(flat) & -8].view(np.uint64)
    some = (np.flatnonzero(words)[:, None] * 8 + np.arange(8)).ravel()
    some = np.concatenate([some, np.arange(len(words) * 8, len(flat))])
    return np.divmod(some[flat[some]], mask.shape[1])


class Best:
    """The k best rows of each query of a pack so far, of those that come before
    the row that its threshold ``(least, last)`` is from."""

    def __init__(self, row: np.ndarray, own: pa.Array, least: np.ndarray, last: pa.Array,
                 q: np.ndarray, alive: np.ndarray, probed: np.ndarray, k: int, exclude_self: bool):
        self.row, self.q, self.alive, self.probed, self.k = row, q, alive, probed, k
        self.rough, self.error = single(q)
        self.own = pc.fill_null(own, 0).to_numpy()
        self.has = pc.is_valid(own).to_numpy(zero_copy_only=False) & exclude_self
        self.least = np.round(least, RANK_DECIMALS)
        self.last = np.array(pc.fill_null(last, NO_ID).to_numpy())
        self.ids = np.zeros((len(row), k), dtype=np.int64)
        self.scores = np.full((len(row), k), -np.inf)

    @classmethod
    def of(cls, batch: pa.RecordBatch, i: int, k: int, exclude_self: bool) -> "Best":
        row, own, least, last = (batch.column(c)[i].values for c in ("row", "own", "least", "last"))
        m = len(row)
        alive, probed = (np.unpackbits(np.frombuffer(batch.column(c)[i].as_buffer(), dtype=np.uint8)
                                       .reshape(m, -1), axis=1).astype(bool)
                         for c in ("alive", "probed"))
        # Copied: the batch goes when the next one comes.
        q = np.frombuffer(batch.column("q")[i].as_buffer()).reshape(m, -1).copy()
        return cls(row.to_numpy().copy(), own, least.to_numpy(), last, q,
                   alive, probed, k, exclude_self)

    def of_block(self, clusters: Clusters, cluster: int, block: int) -> np.ndarray:
        """The queries that a block may hold a row for."""
        done = self.probed[:, cluster] & (own_block(clusters, self.row, cluster) == block)
        return np.flatnonzero(self.alive[:, cluster] & ~done)

    def look_at(self, mine: np.ndarray, ids: np.ndarray, d: np.ndarray) -> None:
        """Score rows for the queries ``mine``."""
        rough, error = single(d)
        for at in (mine[i:i + SLAB] for i in range(0, len(mine), SLAB)):
            q, held, count = self.rough[at], [], 0
            for start in range(0, len(ids), SLAB):
                part = slice(start, start + SLAB)
                with np.errstate(invalid="ignore", over="ignore"):
                    low = self.least[at] - SLACK - self.error[at] * error[part].max()
                    may = ~(q @ rough[part].T < low[:, None].astype(np.float32))
                held.append(self._hits(at, may, ids[part], d[part]))
                count += len(held[-1][0])
                if count > MERGE_HITS:
                    self._keep(held)
                    held, count = [], 0
            if count:
                self._keep(held)

    def _hits(self, at: np.ndarray, may: np.ndarray, ids: np.ndarray, d: np.ndarray):
        """Places of queries, ids and scores of the pairs that come before the
        threshold, all of which are among ``may``."""
        if np.count_nonzero(may) * d.shape[1] > PAIR_NUMBERS:
            scores = self.q[at] @ d.T
            # Of many equal rows, those with higher ids than the threshold's drop out here.
            unit = np.where(ids.min() >= self.last[at], 0.4, -0.6)
            i, j = places(scores >= (self.least[at] + unit * 10.0 ** -RANK_DECIMALS)[:, None])
            score = scores[i, j]
        else:
            i, j = places(may)
            score = np.einsum("ij,ij->i", self.q[at[i]], d[j])
        place, found = at[i], ids[j]
        keyed = np.round(score, RANK_DECIMALS)
        least = self.least[place]
        stays = (keyed > least) | (keyed == least) & (found < self.last[place])
        stays &= ~(self.has[place] & (self.own[place] == found)) & np.isfinite(score)
        return place[stays], found[stays], score[stays]

    def _keep(self, held: list) -> None:
        place, found, score = (np.concatenate(c) for c in zip(*held))
        some = np.unique(place)
        at = np.concatenate([np.repeat(some, self.k), place])
        ids = np.concatenate([self.ids[some].ravel(), found])
        scores = np.concatenate([self.scores[some].ravel(), score])
        order = np.lexsort((ids, -np.round(scores, RANK_DECIMALS), at))
        mine = at[order]
        rank = np.arange(len(mine)) - np.searchsorted(mine, mine, "left")
        mine, order, rank = mine[rank < self.k], order[rank < self.k], rank[rank < self.k]
        self.ids[mine, rank], self.scores[mine, rank] = ids[order], scores[order]
        full = some[np.isfinite(self.scores[some, -1])]     # their k-th best is the threshold
        self.least[full] = np.round(self.scores[full, -1], RANK_DECIMALS)
        self.last[full] = self.ids[full, -1]

    def found(self) -> pa.RecordBatch:
        at, rank = np.nonzero(np.isfinite(self.scores))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.row[at]), pa.array(self.ids[at, rank]),
             pa.array(self.scores[at, rank])], schema=OUT)


def scored(batches: Iterator[pa.RecordBatch], clusters: Clusters, k: int,
           exclude_self: bool) -> Iterator[pa.RecordBatch]:
    """Candidates of pairs of packs; those of one pack of queries come one after
    the other."""
    best, first = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            lead = batch.column("row")[i].values[0].as_py()
            if best is None or lead != first:
                if best is not None:
                    yield best.found()
                best, first = Best.of(batch, i, k, exclude_self), lead
            cluster, block, ids = (batch.column(c)[i].values.to_numpy()
                                   for c in ("cluster", "block", "id"))
            d = np.frombuffer(batch.column("d")[i].as_buffer()).reshape(len(ids), -1)
            edges = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
            for start, stop in zip(edges[:-1], edges[1:]):
                mine = best.of_block(clusters, cluster[start], block[start])
                best.look_at(mine, ids[start:stop], d[start:stop])
    if best is not None:
        yield best.found()


def streamed(queries: DataFrame, n: int, kb_blocks: DataFrame, clusters: Clusters, k: int,
             exclude_self: bool, choose: Callable, probe: Callable) -> DataFrame:
    """``row, id, score`` of the clusters that ``choose`` leaves to each of the
    ``n`` rows of ``queries(row, self_id, vec, least, last)``, without the blocks
    that it probed: among them every row of its k best that comes before
    ``(least, last)``."""
    held, parts = query_packs(queries, n, clusters, choose, probe)
    passed, most = kb_packs(kb_blocks, clusters)
    tasks = queries.sparkSession.sparkContext.defaultParallelism * TASKS_PER_CORE
    groups = min(most, -(-tasks // parts))
    passed = passed.repartitionById(groups, F.pmod("share", F.lit(groups)).cast("int"))
    # Of a product, the first side is streamed and the second held.
    known = queries.sparkSession.sparkContext.broadcast(Clusters(
        clusters.kind, clusters.seeds[:0], clusters.sizes, clusters.first, clusters.blocks))
    return passed.hint("shuffle_replicate_nl").crossJoin(held).mapInArrow(
        lambda batches: scored(batches, known.value, k, exclude_self),
        "row bigint, id bigint, score double")
