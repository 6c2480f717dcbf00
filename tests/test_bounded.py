"""What a Python worker holds at once doesn't follow the size of a batch or of
a cell: tables ten times as large must not need ten times the memory."""
from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from replyscope.operators import frequent, packed, pruned
from replyscope.operators.lcs import lcs_udf

MB = 1 << 20


def peak_mb(work) -> float:
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / MB
    finally:
        tracemalloc.stop()


def sparse(rows: int, terms: int, wide: int, seed: int) -> pa.Array:
    """Unit vectors with ``terms`` of ``wide`` terms each."""
    rng = np.random.default_rng(seed)
    at = np.sort(rng.random((rows, wide)).argpartition(terms - 1, axis=1)[:, :terms], axis=1)
    w = rng.random((rows, terms)) + 0.1
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * terms),
        pa.StructArray.from_arrays([pa.array(at.ravel()), pa.array(w.ravel())], ["term", "w"]))


def cell(q: pa.Array, d: pa.Array, exclude_self: bool = True):
    left = pa.table({"row": np.arange(len(q)), "self_id": np.arange(len(q)), "vec": q,
                     "least": np.full(len(q), -np.inf)})
    right = pa.table({"id": np.arange(len(d)), "vec": d})
    return pruned._scored(pruned.SPARSE, 3, exclude_self)(left, right)


def matrix(column: pa.Array, wide: int) -> np.ndarray:
    out = np.zeros((len(column), wide))
    rows = pruned.SparseRows(column)
    out[rows.row, rows.term] = rows.w
    return out


def test_cell_of_frequent_terms_holds_a_slice_of_its_products():
    q, d = sparse(160, 40, 48, 1), sparse(2048, 40, 48, 2)      # 11 million products
    assert peak_mb(lambda: cell(q, d)) < 120


def test_sliced_cell_has_the_best_rows_of_the_whole_block(monkeypatch):
    q, d = sparse(70, 6, 30, 3), sparse(300, 6, 30, 4)
    monkeypatch.setattr(pruned, "SLICE_ENTRIES", 90)
    monkeypatch.setattr(pruned, "CELL_HITS", 200)
    got = cell(q, d).to_pandas()
    scores = np.round(matrix(q, 30) @ matrix(d, 30).T, pruned.RANK_DECIMALS)
    scores[np.arange(70), np.arange(70)] = -np.inf
    for row in range(70):
        best = sorted(range(300), key=lambda i: (-scores[row, i], i))[:3]
        mine = got[got.row == row]
        assert mine.id.tolist() == best
        assert np.allclose(mine.score, scores[row, best], atol=1e-8)


def test_copies_of_a_batch_come_in_bounded_batches(monkeypatch):
    monkeypatch.setattr(pruned, "SLICE_ENTRIES", 64)
    known = pruned.Clusters(pruned.SPARSE, np.zeros((5, 4)), np.full(5, 9),
                            np.arange(5) * 2, np.full(5, 2))
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(20)), pa.array(range(20)), sparse(20, 3, 8, 5), pa.array(np.zeros(20))],
        ["row", "self_id", "vec", "least"])
    out = list(pruned.copied(batch, known, lambda k, vec, _: np.ones((len(vec), len(k)), bool)))
    assert max(len(b.column(2).flatten()) for b in out) <= 64
    pairs = [(r["row"], r["block"]) for b in out for r in b.to_pylist()]
    assert sorted(pairs) == [(r, b) for r in range(20) for b in range(10)]


@pytest.mark.parametrize("rows", [1, 7, 1024])
def test_batches_are_cut_in_order(rows):
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), sparse(50, 3, 8, 6)], ["id", "vec"])
    parts = list(pruned._sliced(batch, 1, rows))
    assert max(p.num_rows for p in parts) <= rows
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(50))


def vocabulary(n: int) -> packed.Vocabulary:
    return packed.Vocabulary(pa.table({"term": [f"t{i:05d}" for i in range(n)],
                                       "idf": np.linspace(1.0, 3.0, n)}))


def counted(rows: int, terms: int, names: list[str]) -> pa.Array:
    pick = np.tile(np.arange(terms), rows)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * terms),
        pa.StructArray.from_arrays([pa.array(names).take(pa.array(pick)),
                                    pa.array(np.ones(len(pick), np.int32))], ["term", "cnt"]))


def test_vectors_and_cosines_of_a_large_batch_are_made_in_slices():
    vocab, column = vocabulary(500), counted(2000, 400, [f"t{i:05d}" for i in range(400)])
    assert peak_mb(lambda: packed._vectors(column, vocab, True)) < 25
    assert peak_mb(lambda: packed._dot(column, column, vocab)) < 40


def test_summary_takes_bounded_slices_of_a_batch():
    column = counted(3000, 200, [f"t{i:05d}" for i in range(200)])
    batch = pa.RecordBatch.from_arrays([column], ["tc"])
    parts = [len(terms) for terms, _ in frequent._entries(batch)]
    assert sum(parts) == 600_000 and max(parts) <= 1 << 18


def test_lcs_holds_the_tokens_of_a_slice():
    words = pa.array([f"word{i}" for i in range(300)]).take(pa.array(np.tile(np.arange(300), 2000)))
    column = pa.ListArray.from_arrays(pa.array(np.arange(2001, dtype=np.int32) * 300), words)
    made = []
    assert peak_mb(lambda: made.append(lcs_udf.func(column, column))) < 25
    assert made[0].to_pylist() == [300] * 2000
