"""Helpers shared by the operators of this subpackage: Arrow batches in
byte-bounded slices, and words hashed batch-wise with numpy.

A word is a run of bytes other than space and ``\\t \\n \\v \\f \\r``, which in
UTF-8 are never part of a longer character."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

SLICE_BYTES = 1 << 20
_SEED = 20240229
_TABLE = np.random.default_rng(_SEED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def only(df: DataFrame, **kinds: str) -> DataFrame:
    """The named columns cast to the given types. Whatever else the table
    carries, clashing names included, stays out of the operator."""
    return df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c, kind in kinds.items()])


def map_batches(df: DataFrame, fn: Callable, schema: str, text: str | None = None,
                setup: Callable | None = None) -> DataFrame:
    """``mapInArrow`` with ``fn(batch, state) -> dict of columns`` on slices of
    bounded bytes: a batch of very long texts is worked off row by row, so a
    task's memory follows ``SLICE_BYTES`` and its longest text only."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    arrow = _arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for batch in batches:
            for part in slices(batch, text):
                out = fn(part, state)
                if out is not None:
                    yield pa.RecordBatch.from_arrays(
                        [_column(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, fields)


def _arrow_schema(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(fields)


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, (pa.Array, pa.ChunkedArray)):
        values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def slices(batch: pa.RecordBatch, text: str | None) -> Iterator[pa.RecordBatch]:
    if batch.num_rows == 0:
        return
    if text is None:
        yield batch
        return
    ends = _offsets(batch.column(batch.schema.get_field_index(text)))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def _offsets(column: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    buffer = column.buffers()[1]
    if buffer is None or buffer.size == 0:
        return np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(buffer, dtype=kind)[column.offset:column.offset + len(column) + 1] \
        .astype(np.int64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a slice and the offset of each row in them; a null row
    has no bytes."""
    offsets = _offsets(column)
    if column.null_count:
        values = column.to_pylist()
        parts = [v.encode() if isinstance(v, str) else (v or b"") for v in values]
        offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        return np.frombuffer(b"".join(parts), dtype=np.uint8), offsets
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_spans(raw: np.ndarray, at: np.ndarray, start: np.ndarray) \
        -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and length of each span: the bytes at positions ``at`` from
    one ``start`` up to the next, which is itself in ``at``."""
    if not len(start):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    lead = np.searchsorted(at, start)
    length = np.diff(np.append(lead, len(at)))
    place = np.arange(len(at)) - np.repeat(lead, length)
    values = _TABLE[raw[at]] * powers(int(length.max()))[place]
    return mix(np.add.reduceat(values, lead) + length.astype(np.uint64)), length


class Words:
    """Words of a slice: ``hash``, byte range ``start``/``end``, and ``first``,
    the index of each row's first word (one more entry at the end)."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, fold: bool = False):
        if fold:
            raw = _FOLD[raw]
        inside = ~_IS_SPACE[raw]
        before = np.empty(len(raw), dtype=bool)
        before[:1] = False
        before[1:] = inside[:-1]
        edges = offsets[1:-1]
        before[edges[edges < len(raw)]] = False
        self.start = np.flatnonzero(inside & ~before)
        self.hash, length = hash_spans(raw, np.flatnonzero(inside), self.start)
        self.end = self.start + length
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start words of all ``size``-word windows inside one row, and their
        hashes."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        h = np.zeros(n, dtype=np.uint64)
        for j in range(size):
            h = (h + self.hash[j:j + n]) * _BASE
            h ^= h >> np.uint64(29)
        at = np.flatnonzero(self.row[:n] == self.row[size - 1:])
        return at, mix(h[at])


_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, 256), _BASE, dtype=np.uint64)
            steps[0] = 1
            _POWERS = np.multiply.accumulate(steps)
    return _POWERS


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


class PairTable:
    """Values of pairs of numbers; -1 for a pair without one. Pairs whose slot
    is taken stand in a sorted list, which only lookups of such slots reach."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        key = np.asarray([a << 32 | b for a, b in pairs], dtype=np.int64)
        value = np.asarray(list(pairs.values()), dtype=np.int64)
        bits = max(len(key) * 4, 2).bit_length()
        self.shift = np.uint64(64 - bits)
        self.key = np.full(1 << bits, -1, dtype=np.int64)
        self.value = np.full(1 << bits, -1, dtype=np.int64)
        slot = self._slot(key)
        _, first = np.unique(slot, return_index=True)
        self.key[slot[first]], self.value[slot[first]] = key[first], value[first]
        late = np.setdiff1d(np.arange(len(key)), first)
        late = late[np.argsort(key[late])]
        self.late_key, self.late_value = key[late], value[late]
        self.full = np.zeros(1 << bits, dtype=bool)
        self.full[slot[late]] = True

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * _BASE >> self.shift).view(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        slot = self._slot(key)
        met = self.key[slot] == key
        out = np.where(met, self.value[slot], -1)
        if len(self.late_key):
            more = np.flatnonzero(self.full[slot] & ~met)
            if len(more):
                at = np.minimum(np.searchsorted(self.late_key, key[more]), len(self.late_key) - 1)
                found = self.late_key[at] == key[more]
                out[more[found]] = self.late_value[at[found]]
        return out
