"""Masked pseudo-likelihood scores from a bidirectional window network.

The network predicts every word from the ``WINDOW`` words on both sides of it:
their embeddings, by place, pass one hidden layer, and the word's probability
is that of its class times that of the word within its class. A document's
score is the sum of the log-probabilities of its words, each given all of its
neighbours.

The vocabulary is every word that the whole corpus holds ``OWN_COUNT`` times or
more, and the ``VOCABULARY`` most frequent ones in any case, so it grows with
the corpus. The classes hold the most frequent words and buckets; the further
words of a bucket, and one leaf for all words outside of the vocabulary, are
leaves of a binary tree in it, so the cost of a word follows the tree's depth.
A word outside of the vocabulary has its share of the corpus count of that
leaf. Counts of words met ``TABLE_COUNT`` times or more are broadcast, those of
the others joined.

Training is data-parallel in numpy: in each round every partition runs
minibatch steps over all its documents from the shared weights, and the
partitions' changes are averaged in Spark, weighted by their words. The driver
holds the weights and the broadcast counts."""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .common import Words, map_batches, only, signed, slices, text_bytes

VOCABULARY = 896               # words that are ids of a class, and kept at any count
BUCKETS = 128                  # for all other words
OWN_COUNT = 1000               # a word's count from which it has weights of its own
TABLE_COUNT = 50               # and from which its count is broadcast
CLASSES = 32                   # of the (VOCABULARY + BUCKETS) ids, equal in number
WINDOW = 2
WIDTH = 12
HIDDEN = 24
BATCH = 4096
ROUNDS = 1
RATE = 4.0
SEED = 11
IDS = VOCABULARY + BUCKETS
EDGE = IDS                     # stands beyond both ends of a document
FURTHER = IDS + 1              # ids of the vocabulary's words after the first VOCABULARY
PAIRED = (HIDDEN + 2) // 2 * 2
SURE = 30.0                    # log-odds of a branch whose other side is empty
BLOCK = 1 << 14                # words scored or trained on at once


class Network:
    """``embed`` (ids, the edge and further words), ``mix`` and ``lean`` (hidden
    layer), ``group`` (classes), ``word`` (ids within their class) and ``tree``
    (branches within a bucket, as a heap of ``2 ** depth`` nodes each; leaf 0
    stands for all words outside of the vocabulary)."""

    def __init__(self, flat: np.ndarray | None = None, further: int = 0):
        self.depth = (-(-further // BUCKETS)).bit_length()
        self.shapes = {"embed": (IDS + 1 + further, WIDTH), "mix": (2 * WINDOW * WIDTH, HIDDEN),
                       "lean": (HIDDEN,), "group": (HIDDEN + 1, CLASSES),
                       "word": (CLASSES, HIDDEN + 1, IDS // CLASSES),
                       "tree": ((BUCKETS << self.depth) if self.depth else 0, HIDDEN + 1)}
        rng = np.random.default_rng(SEED)
        at = 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            value = flat[at:at + n].reshape(shape) if flat is not None else \
                np.zeros(shape) if name == "tree" else rng.normal(0, .1, shape)
            setattr(self, name, np.array(value, dtype=np.float32))
            at += n
        # Of each id: its class and place in it, whether it is in a bucket, its
        # leaf there, and its turn when words are sorted by all of these.
        rank = np.arange(FURTHER + further) - FURTHER
        self.top = np.where(rank >= 0, VOCABULARY + rank % BUCKETS, rank + FURTHER)
        self.kind, self.place = self.top % CLASSES, self.top // CLASSES
        self.leaf = np.where(rank >= 0, 1 + rank // BUCKETS, 0)
        turn = np.empty(len(rank), dtype=np.uint16 if len(rank) <= 1 << 16 else np.int32)
        turn[np.lexsort((self.leaf, self.place, self.kind))] = np.arange(len(rank))
        self.turn = turn

    def start_from(self, counts: np.ndarray) -> "Network":
        """Biases that give each id and further word its share of the corpus
        before training, in a network for as many further words."""
        further = max(len(counts) - FURTHER, 0)
        if further != len(self.embed) - FURTHER:
            return Network(further=further).start_from(counts)
        share = np.log((counts[:IDS] + 1) / (counts[:IDS] + 1).sum())
        by_class = share.reshape(-1, CLASSES)
        self.group[-1] = np.logaddexp.reduce(by_class, axis=0)
        self.word[:, -1] = by_class.T
        if self.depth:
            leaves = np.zeros((BUCKETS, 1 << self.depth))
            rank = np.arange(further)
            leaves[rank % BUCKETS, 1 + rank // BUCKETS] = counts[FURTHER:]
            leaves[:, 0] = counts[VOCABULARY:IDS] - leaves.sum(axis=1)
            odds = self.tree[:, -1].reshape(BUCKETS, -1)
            for level in range(self.depth):
                side = leaves.reshape(BUCKETS, 1 << level, 2, -1).sum(axis=3)
                with np.errstate(divide="ignore", invalid="ignore"):
                    z = np.log(side[..., 1]) - np.log(side[..., 0])
                odds[:, 1 << level:2 << level] = np.clip(np.nan_to_num(z, nan=0.0), -SURE, SURE)
        return self

    def _branches(self, centre: np.ndarray):
        """The words in buckets; their tree nodes from the root on, one row a
        level, and which way they go."""
        at = np.flatnonzero(self.top.take(centre) >= VOCABULARY) if self.depth \
            else np.zeros(0, dtype=np.int64)
        leaf = self.leaf.take(centre[at])
        level = np.arange(self.depth)[:, None]
        nodes = ((self.top[centre[at]] - VOCABULARY) << self.depth) \
            + ((1 << level) | (leaf >> (self.depth - level)))
        return at, nodes, (leaf >> (self.depth - 1 - level) & 1).astype(bool)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.shapes])

    def _forward(self, around: np.ndarray, centre: np.ndarray):
        """Words come sorted by class; ``cut`` parts the classes. ``p`` and
        ``q`` are the logits of classes and of ids within the word's class."""
        x = self.embed.take(around, axis=0).reshape(len(around), -1)
        h = np.ones((len(around), HIDDEN + 1), dtype=np.float32)
        y = x @ self.mix
        y += self.lean
        h[:, :HIDDEN] = np.tanh(y, out=y)
        kind = self.kind.take(centre)
        p = h @ self.group
        cut = np.searchsorted(kind, np.arange(CLASSES + 1)).tolist()
        q = np.empty((len(around), IDS // CLASSES), dtype=np.float32)
        for k in range(CLASSES):
            if cut[k] < cut[k + 1]:
                np.matmul(h[cut[k]:cut[k + 1]], self.word[k], out=q[cut[k]:cut[k + 1]])
        return x, h, kind, self.place.take(centre), p, q, cut

    def log_probability(self, around: np.ndarray, centre: np.ndarray) -> np.ndarray:
        order = np.argsort(self.turn.take(centre), kind="stable")
        around, centre = around.take(order, axis=0), centre.take(order)
        _, h, kind, place, p, q, _ = self._forward(around, centre)
        log_p = _log_share(p, kind) + _log_share(q, place)
        at, nodes, right = self._branches(centre)
        if len(at):
            branch = self.tree.take(nodes, axis=0)
            z = np.einsum("lij,ij->li", branch, h.take(at, axis=0))
            # log(1 + e^z) of the way not taken
            z[right] *= -1
            log_p[at] -= (np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))) \
                .sum(axis=0, dtype=np.float64)
        out = np.empty(len(centre))
        out[order] = log_p
        return out

    def step(self, around: np.ndarray, centre: np.ndarray, rate: float) -> None:
        order = np.argsort(self.turn.take(centre), kind="stable")
        around, centre = around.take(order, axis=0), centre.take(order)
        x, h, kind, place, p, q, cut = self._forward(around, centre)
        row, n = np.arange(len(centre)), len(centre)
        p, q = _softmax(p), _softmax(q)
        p[row, kind] -= 1
        q[row, place] -= 1
        back = p @ self.group.T
        self.group -= rate / n * (h.T @ p)
        for k in range(CLASSES):
            if cut[k] < cut[k + 1]:
                part = slice(cut[k], cut[k + 1])
                back[part] += q[part] @ self.word[k].T
                self.word[k] -= rate / n * (h[part].T @ q[part])
        at, nodes, right = self._branches(centre)
        if len(at):
            branch, here = self.tree.take(nodes, axis=0), h.take(at, axis=0)
            z = np.einsum("lij,ij->li", branch, here)
            off = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - right.astype(np.float32)
            back[at] += np.einsum("li,lij->ij", off, branch)
            # Words with the same node stand together at every level. Two
            # columns are added up as one complex number.
            rows = np.zeros((*nodes.shape, PAIRED), dtype=np.float32)
            np.multiply(off[:, :, None], here, out=rows[..., :HIDDEN + 1])
            rows = rows.reshape(-1, PAIRED).view(np.complex64)
            nodes = nodes.ravel()
            first = np.flatnonzero(np.diff(nodes, prepend=-1))
            sums = np.add.reduceat(rows, first, axis=0).view(np.float32)
            self.tree[nodes[first]] -= rate / n * sums[:, :HIDDEN + 1]
        back = back[:, :HIDDEN] * (1 - h[:, :HIDDEN] ** 2)
        down = (self.mix @ (-rate / n * back.T)).reshape(-1, WIDTH, n)
        self.mix -= rate / n * (x.T @ back)
        self.lean -= rate / n * back.sum(axis=0)
        _add_rows(self.embed, around.T.ravel(),
                  (down[:, i].ravel() for i in range(WIDTH)))


def _add_rows(table: np.ndarray, at: np.ndarray, columns: Iterable[np.ndarray]) -> None:
    """Add rows, given by column, to a table at places that may repeat."""
    met = np.zeros(len(table), dtype=bool)
    met[at] = True
    where = np.flatnonzero(met)
    slot = np.empty(len(table), dtype=np.int64)
    slot[where] = np.arange(len(where))
    of = slot.take(at)
    table[where] += np.stack([np.bincount(of, c) for c in columns], axis=1)


def _exp(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials of the rows, up to a factor for each, and their sums."""
    if not -60 < x.min(initial=0) <= x.max(initial=0) < 60:     # else they are safe as they are
        x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    return x, x @ np.ones(x.shape[1], dtype=x.dtype)


def _softmax(x: np.ndarray) -> np.ndarray:
    x, total = _exp(x)
    x /= total[:, None]
    return x


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Logarithm of the softmax of each row at one place."""
    x, total = _exp(x)
    return np.log(np.maximum(x[np.arange(len(x)), at] / total, 1e-30), dtype=np.float64)


class Reader:
    """Turns texts into word ids and their neighbours."""

    def __init__(self, vocabulary: np.ndarray):
        order = np.argsort(vocabulary)
        self.hash = vocabulary[order]
        self.id = np.where(order < VOCABULARY, order, order - VOCABULARY + FURTHER)
        # Hashes are in order, so the upper bits tell where to look for one; a
        # slot with several is searched.
        self.shift = np.uint64(64 - max(8 * len(order), 2).bit_length())
        slot = (self.hash >> self.shift).view(np.int64)
        self.several = np.bincount(slot, minlength=1 << (64 - int(self.shift))) > 1
        self.at = np.zeros(len(self.several), dtype=np.int32)
        self.at[slot] = np.arange(len(slot))

    def read(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbour ids (one row per word), word ids and first words per row."""
        return self.read_words(Words(*text_bytes(column), fold=True))

    def read_words(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids = (words.hash % np.uint64(BUCKETS)).astype(np.int64) + VOCABULARY
        if len(self.hash):
            slot = (words.hash >> self.shift).view(np.int64)
            at = self.at.take(slot)
            more = np.flatnonzero(self.several.take(slot))
            at[more] = np.minimum(np.searchsorted(self.hash, words.hash[more]), len(self.hash) - 1)
            ids = np.where(self.hash.take(at) == words.hash, self.id.take(at), ids)
        # Documents stand one after another with edges between them.
        apart = np.full(len(ids) + WINDOW * len(words.first), EDGE, dtype=np.int64)
        place = np.arange(len(ids)) + WINDOW * (words.row + 1)
        apart[place] = ids
        around = np.empty((len(ids), 2 * WINDOW), dtype=np.int64)
        for j, d in enumerate([*range(-WINDOW, 0), *range(1, WINDOW + 1)]):
            around[:, j] = apart.take(place + d)
        return around, ids, words.first


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (hash) and ``n`` of all words of all documents; counted per
    slice, then per partition, then over the corpus."""
    def count(part: pa.RecordBatch, _):
        words, n = np.unique(Words(*text_bytes(part.column(1)), fold=True).hash,
                             return_counts=True)
        return {"word": signed(words), "n": n}

    return (map_batches(docs, count, "word bigint, n bigint", text="text")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _table(counted: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts, most frequent first."""
    table = counted.select("word", "n").toArrow()
    word, n = (np.asarray(table.column(c).to_numpy(), dtype=np.int64) for c in (0, 1))
    order = np.lexsort((word, -n))
    return word[order].view(np.uint64), n[order]


def frequent_words(docs: DataFrame, size: int = VOCABULARY, own: int = OWN_COUNT,
                   counted: DataFrame | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words counted ``own`` times or more, and of the ``size``
    most frequent ones in any case; and the counts of all ids. A bucket counts
    all words in it: the further ones dealt to it and those outside by hash."""
    counted = count_words(docs) if counted is None else counted
    words, n = _table(counted.where(F.col("n") >= own))
    if len(words) < size:
        words, n = _table(counted.orderBy(F.desc("n"), "word").limit(size))
    counts = np.zeros(FURTHER + max(len(words) - VOCABULARY, 0))
    counts[:min(len(words), VOCABULARY)] = n[:VOCABULARY]
    counts[FURTHER:] = n[VOCABULARY:]
    bucket = F.col("word").bitwiseAND(F.lit(BUCKETS - 1))
    every = np.zeros(BUCKETS)
    for r in counted.groupBy(bucket.alias("bucket")).agg(F.sum("n").alias("n")).collect():
        every[r.bucket] = r.n
    rest = every - np.bincount((words % np.uint64(BUCKETS)).astype(np.int64), n, BUCKETS)
    rank = np.arange(len(counts) - FURTHER)
    counts[VOCABULARY:IDS] = rest + np.bincount(rank % BUCKETS, counts[FURTHER:], BUCKETS)
    return words, counts


def outside(counts: np.ndarray) -> np.ndarray:
    """Count of the words outside of the vocabulary, per bucket."""
    rank = np.arange(max(len(counts) - FURTHER, 0))
    return counts[VOCABULARY:IDS] - np.bincount(rank % BUCKETS, counts[FURTHER:], BUCKETS)


def train(docs: DataFrame, vocabulary: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS,
          rate: float = RATE) -> Network:
    """Rounds of local steps over all documents and averages of the weights."""
    network = Network().start_from(counts)
    further = len(network.embed) - FURTHER
    chunk = 4096
    for turn in range(rounds):
        start = network.flat()
        shared = docs.sparkSession.sparkContext.broadcast((start, vocabulary))

        def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            before, words = shared.value
            reader, local, seen = Reader(words), Network(before, further), 0
            rng = np.random.default_rng(SEED + turn)
            for batch in batches:
                for part in slices(batch, "text"):
                    around, ids, _ = reader.read(part.column(1))
                    order = rng.permutation(len(ids))
                    for i in range(0, len(ids), BATCH):
                        at = order[i:i + BATCH]
                        local.step(around.take(at, axis=0), ids.take(at),
                                   rate * len(at) / BATCH)
                    seen += len(ids)
            if not seen:
                return
            change = local.flat() - before
            moved = [i for i in range(0, len(change), chunk) if change[i:i + chunk].any()]
            for i in range(0, len(moved) + 1, 64):      # piece -1 tells the words seen
                at = moved[i:i + 64]
                pieces = [change[j:j + chunk] for j in at] + ([] if i else [change[:0]])
                yield pa.RecordBatch.from_pydict(
                    {"piece": pa.array([j // chunk for j in at] + ([] if i else [-1]), pa.int32()),
                     "seen": pa.array([float(seen)] * len(pieces), pa.float64()),
                     "weights": pa.array(pieces, pa.list_(pa.float32()))})

        def average(group: pa.Table) -> pa.Table:
            seen = group.column("seen").to_numpy()
            total = 0.0
            for n, piece in zip(seen, group.column("weights")):
                total = total + n * np.asarray(piece.values, dtype=np.float64)
            return pa.table({"piece": group.column("piece")[:1],
                             "seen": pa.array([seen.sum()], pa.float64()),
                             "weights": pa.array([total / seen.sum()], pa.list_(pa.float32()))})

        schema = "piece int, seen double, weights array<float>"
        rows = (docs.mapInArrow(learn, schema).groupBy("piece").applyInArrow(average, schema)
                .toArrow())
        shared.unpersist()
        of = dict(zip(rows.column(0).to_pylist(), range(rows.num_rows)))
        if not of:
            return network
        seen, weights = rows.column(1).to_pylist(), rows.column(2)
        for piece, i in of.items():
            if piece >= 0:
                start[piece * chunk:(piece + 1) * chunk] += \
                    np.asarray(weights[i].values) * (seen[i] / seen[of[-1]])
        network = Network(start, further)
    return network


def score(docs: DataFrame, network: Network, vocabulary: np.ndarray,
          counts: np.ndarray | None = None, counted: DataFrame | None = None,
          scratch: Scratch | None = None) -> DataFrame:
    """Scores of all rows. With the ``counts`` of all ids and the table of the
    corpus counts, a word outside of the vocabulary is scored as that word,
    else as any such word of its bucket."""
    spark = docs.sparkSession
    rest = outside(counts) if counts is not None else np.zeros(BUCKETS)
    each = bool(rest.any())
    known, n = _table(counted.where(F.col("n") >= TABLE_COUNT)) if each \
        else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    order = np.argsort(known)
    shared = spark.sparkContext.broadcast((network.flat(), vocabulary, known[order],
                                           n[order].astype(np.float32)))
    further = len(network.embed) - FURTHER

    def batch(part: pa.RecordBatch, state):
        model, reader, hashes, times = state
        words = Words(*text_bytes(part.column(1)), fold=True)
        around, ids, first = reader.read_words(words)
        log_p = np.concatenate([np.zeros(0), *[
            model.log_probability(around[i:i + BLOCK], ids[i:i + BLOCK])
            for i in range(0, len(ids), BLOCK)]])
        lone = np.zeros(len(ids), dtype=bool)
        if each:
            out = np.flatnonzero((ids >= VOCABULARY) & (ids < IDS))
            log_p[out] -= np.log(rest[ids[out] - VOCABULARY])
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, words.hash[out]), len(hashes) - 1)
                met = hashes[at] == words.hash[out]
                log_p[out[met]] += np.log(times[at[met]], dtype=np.float64)
                out = out[~met]
            lone[out] = True
        n = np.diff(first)
        sums = np.asarray([log_p[a:b].sum() for a, b in zip(first[:-1], first[1:])])
        ends = np.concatenate([[0], np.cumsum(lone)])[first].astype(np.int32)
        return {"doc_id": part.column(0), "n_words": n, "log_likelihood": sums,
                "lone": pa.ListArray.from_arrays(pa.array(ends),
                                                 pa.array(signed(words.hash[lone])))}

    def setup():
        flat, words, hashes, times = shared.value
        return Network(flat, further), Reader(words), hashes, times

    scored = map_batches(docs, batch, "doc_id bigint, n_words bigint, log_likelihood double, "
                                      "lone array<bigint>", text="text", setup=setup)
    total = F.col("log_likelihood")
    if each:
        # The counts of rare words come by a join; no word has more than
        # TABLE_COUNT rows in it. Whole numbers add up the same in any order.
        scored = (scratch or Scratch(spark)).table(
            scored.withColumn("row", F.monotonically_increasing_id()))
        rare = counted.where(F.col("n") < TABLE_COUNT).select(
            "word", F.round(F.log("n") * 2.0 ** 32).cast("bigint").alias("log_n"))
        more = (scored.select("row", F.explode("lone").alias("word")).join(rare, "word")
                .groupBy("row").agg((F.sum("log_n") / 2.0 ** 32).alias("more")))
        scored = scored.drop("lone").join(more, "row", "left")
        total = total + F.coalesce("more", F.lit(0.0))
    return scored.select("doc_id", "n_words", total.alias("log_likelihood"),
                         F.when(F.col("n_words") > 0, total / F.col("n_words"))
                         .alias("mean_log_likelihood"))


def pseudo_likelihood(df: DataFrame, rounds: int = ROUNDS,
                      scratch: Scratch | None = None) -> DataFrame:
    """One row per input row: ``doc_id, n_words, log_likelihood,
    mean_log_likelihood`` (natural logarithms, so the pseudo-perplexity is
    ``exp(-mean_log_likelihood)``).

    Words are lower-cased A-Z. A null or wordless text has no words, a sum of 0
    and a null mean; repeated rows are scored (and trained on) each; an empty
    table gives no rows. Training covers all documents; its result depends on
    how the table is dealt into partitions, as averages do."""
    scratch = scratch or Scratch(df.sparkSession)
    docs = only(df, doc_id="bigint", text="string")
    counted = scratch.table(count_words(docs))
    vocabulary, counts = frequent_words(docs, counted=counted)
    network = train(docs, vocabulary, counts, rounds)
    return score(docs, network, vocabulary, counts, counted, scratch)
