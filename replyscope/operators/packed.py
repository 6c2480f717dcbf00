"""V4, M1 and M2 inside the row: a vocabulary of bounded size as packed arrays.

A text's counted terms are looked up, weighed and scaled to unit length in Arrow
batches where the text is, so that neither a vector nor its norm needs a shuffle;
a pair's two texts are compared there, too. Terms are numbered in term order, so
the same vocabulary always gives the same numbers. A vocabulary without a small
bound isn't packed: the callers join it instead."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import small

# Words or terms that are worked off at once.
SLICE_ENTRIES = 1 << 17


class Vocabulary:
    """Terms in order, and their idf."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("term").combine_chunks()
        self.terms = _whole(table["term"]).cast(pa.string())
        self.idf = table["idf"].to_numpy().astype(np.float64)

    def __len__(self) -> int:
        return len(self.idf)

    def number(self, terms: pa.Array) -> np.ndarray:
        """Number of each term, -1 outside of the vocabulary."""
        if not len(self):
            return np.full(len(terms), -1, dtype=np.int64)
        at = pc.index_in(terms.cast(pa.string()), value_set=self.terms)
        return pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _whole(column) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def packed(vocab: DataFrame, bound: int | None):
    """The vocabulary as a broadcast, if its number of terms has a bound that
    allows it."""
    if not small(bound):
        return None
    return vocab.sparkSession.sparkContext.broadcast(
        Vocabulary(vocab.select("term", "idf").toArrow()))


def list_sizes(column: pa.Array) -> np.ndarray:
    """Entries per row of a list column; a null row has none."""
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False) \
        .astype(np.int64)


def slices(*sizes: np.ndarray, entries: int | None = None,
           rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of rows with a bounded number of entries (and of rows), one row at
    least."""
    ends = np.cumsum(sum(sizes))
    start = 0
    while start < len(ends):
        base = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, base + (entries or SLICE_ENTRIES), side="right"))
        stop = max(start + 1, stop if rows is None else min(stop, start + rows))
        yield start, stop
        start = stop


def unit(of: np.ndarray, number: np.ndarray, count: np.ndarray, n: int,
         vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of ``n`` documents, of which known terms stay, with their weight
    ``count * idf`` over the document's length."""
    known = number >= 0
    of, number = of[known], number[known]
    raw = count[known] * vocab.idf[number]
    norm = np.sqrt(np.bincount(of, raw * raw, minlength=n))
    return of, number, raw / norm[of]


def _counted(column: pa.Array, vocab: Vocabulary):
    """Document, term number and weight of a list column of (term, cnt)."""
    sizes = list_sizes(column)
    flat = column.flatten()
    return unit(np.repeat(np.arange(len(sizes)), sizes), vocab.number(flat.field(0)),
                flat.field(1).to_numpy(zero_copy_only=False).astype(np.float64), len(sizes), vocab)


def _vectors(column: pa.Array, vocab: Vocabulary, names: bool) -> pa.Array:
    parts = []
    for start, stop in slices(list_sizes(column)):
        of, number, w = _counted(column.slice(start, stop - start), vocab)
        order = np.lexsort((number, of))
        edge = np.searchsorted(of[order], np.arange(stop - start + 1))
        numbers = pa.array(number[order])
        term = vocab.terms.take(numbers) if names else numbers
        parts.append(pa.ListArray.from_arrays(
            pa.array(edge.astype(np.int32)),
            pa.StructArray.from_arrays([term, pa.array(w[order])], ["term", "w"])))
    kind = pa.list_(pa.struct([("term", pa.string() if names else pa.int64()),
                               ("w", pa.float64())]))
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def vector(counts: str, shared, names: bool = False) -> Column:
    """V4 + V5: ``array<struct<term, w>>`` of a column of ``(term, cnt)``, with
    terms as numbers or, with ``names``, as text; empty if no term is known."""
    kind = "string" if names else "bigint"

    @F.arrow_udf(f"array<struct<term:{kind},w:double>>")
    def weigh(column: pa.Array) -> pa.Array:
        return _vectors(column, shared.value, names)

    return weigh(F.col(counts))


def _dot(left: pa.Array, right: pa.Array, vocab: Vocabulary) -> np.ndarray:
    out = []
    for start, stop in slices(list_sizes(left), list_sizes(right)):
        n, size = stop - start, max(len(vocab), 1)
        a, at, wa = _counted(left.slice(start, n), vocab)
        b, bt, wb = _counted(right.slice(start, n), vocab)
        # A term stands once in a text's counts, so its code does, too.
        _, i, j = np.intersect1d(a * size + at, b * size + bt, assume_unique=True,
                                 return_indices=True)
        out.append(np.bincount(a[i], wa[i] * wb[j], minlength=n))
    return np.concatenate(out).astype(np.float64) if out else np.zeros(0)


def cosine(left: str, right: str, shared) -> Column:
    """M1: cosine of two columns of ``(term, cnt)``, 0 where a side has no known
    term, within [0, 1]."""
    @F.arrow_udf("double")
    def dot(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.clip(_dot(a, b, shared.value), 0.0, 1.0))

    return dot(F.col(left), F.col(right))


# ------------------------------------------------------------------ alignment
class _Side:
    """Words of one text of each pair: ``pair`` and ``count`` per word, and the
    unit vectors of words as one-word documents."""

    def __init__(self, words: pa.Array, terms: pa.Array, vocab: Vocabulary):
        sizes = list_sizes(words)
        self.pair = np.repeat(np.arange(len(sizes)), sizes)
        self.count = words.flatten().field(1).to_numpy(zero_copy_only=False).astype(np.float64)
        each = terms.flatten()
        of = np.repeat(np.arange(len(each)), list_sizes(each))
        number = vocab.number(each.flatten())
        size = max(len(vocab), 1)
        code, times = np.unique((of * size + number)[number >= 0], return_counts=True)
        self.word, self.term, self.w = unit(code // size, code % size, times.astype(np.float64),
                                            len(each), vocab)


def best_matches(g: _Side, r: _Side, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word of either side its highest similarity to a word of the
    other side of the same pair; only words that share a term can be similar."""
    left = g.pair[g.word] * terms + g.term
    right = r.pair[r.word] * terms + r.term
    order = np.argsort(right, kind="stable")
    low = np.searchsorted(right[order], left, "left")
    meets = np.searchsorted(right[order], left, "right") - low
    at = order[np.repeat(low - (np.cumsum(meets) - meets), meets) + np.arange(int(meets.sum()))]
    mine = np.repeat(np.arange(len(left)), meets)
    key, place = np.unique(g.word[mine] * max(len(r.pair), 1) + r.word[at], return_inverse=True)
    sim = np.bincount(place, g.w[mine] * r.w[at], minlength=len(key))
    best = np.zeros(len(g.pair)), np.zeros(len(r.pair))
    np.maximum.at(best[0], key // max(len(r.pair), 1), sim)
    np.maximum.at(best[1], key % max(len(r.pair), 1), sim)
    return best


def alignment(g_words: str, g_terms: str, r_words: str, r_terms: str, shared) -> Column:
    """M2: ``struct<precision, recall>``: the mean over all tokens of a side of
    the best similarity to any token of the other. ``*_words`` are columns of
    ``(word, cnt)`` with one word at least, ``*_terms`` the terms of each."""
    @F.arrow_udf("precision double, recall double")
    def align(gw: pa.Array, gt: pa.Array, rw: pa.Array, rt: pa.Array) -> pa.Array:
        vocab = shared.value
        out = [np.zeros((0, 2))]
        for start, stop in slices(list_sizes(gw), list_sizes(rw)):
            n = stop - start
            g = _Side(gw.slice(start, n), gt.slice(start, n), vocab)
            r = _Side(rw.slice(start, n), rt.slice(start, n), vocab)
            best = best_matches(g, r, max(len(vocab), 1))
            out.append(np.stack([
                np.bincount(s.pair, s.count * b, minlength=n)
                / np.maximum(np.bincount(s.pair, s.count, minlength=n), 1.0)
                for s, b in zip((g, r), best)], axis=1))
        both = np.concatenate(out)
        return pa.StructArray.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])],
                                          ["precision", "recall"])

    return align(F.col(g_words), F.col(g_terms), F.col(r_words), F.col(r_terms))
