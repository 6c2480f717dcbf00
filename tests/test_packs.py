"""The dense search where bounds skip little: the same rows as scoring every
pair, and nothing written that grows with queries x clusters."""
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrame

from replyscope.operators import packs, pruned
from replyscope.operators.dense import search_dense
from replyscope.operators.index import KbIndex
from replyscope.operators.retrieve import numbered
from replyscope.session import Scratch

from test_pruned import dense_brute, dense_frames, found, same


def scattered(rng, n, width=16):
    """Unit vectors in all directions, which no bound tells apart."""
    m = rng.normal(size=(n, width))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


@pytest.fixture
def written(monkeypatch):
    """Rows of every table that a search writes."""
    rows, table = [], Scratch.table

    def counted(self, df: DataFrame) -> DataFrame:
        out = table(self, df)
        rows.append(out.count())
        return out
    monkeypatch.setattr(Scratch, "table", counted)
    return rows


def test_rows_written_follow_the_rows_and_not_the_clusters(spark, written):
    rng = np.random.default_rng(11)
    kb = dict(enumerate(scattered(rng, 600)))
    queries = {i: (i, v) for i, v in kb.items()}
    s = search_dense(*dense_frames(spark, queries, kb), 3, True, cluster_rows=20)
    same(found(s), dense_brute(queries, kb, 3, True))
    assert len(s.clusters) == 30 and s.copies[1].count() > 10 * len(kb)
    # Both sides, the rows in their clusters, and at most 2 copies of a query with
    # their candidates; before, a copy per query and cluster more.
    assert sum(written) < 15 * len(kb)


@pytest.mark.parametrize("k, exclude, most, pack", [(3, True, 0, 4096), (25, False, 0, 1 << 20),
                                                    (400, True, 0, 2048), (3, True, 99, 4096)])
def test_streamed_equals_scoring_everything(spark, monkeypatch, k, exclude, most, pack):
    monkeypatch.setattr(pruned, "MOST_COPIES", most)
    monkeypatch.setattr(packs, "PACK_BYTES", pack)
    monkeypatch.setattr(packs, "TASKS_PER_CORE", 3)
    rng = np.random.default_rng(k)
    kb = dict(enumerate(scattered(rng, 300, 6)))
    kb |= {i: kb[10].copy() for i in range(20, 90)}                 # many equal rows
    kb |= {4: np.zeros(6), 5: 3.0 * kb[8], 6: -kb[10], 7: 1e-30 * kb[8]}
    queries = {i: (i, kb[i]) for i in range(0, 300, 2)}
    queries |= {900: (None, np.zeros(6)), 901: (None, -kb[10]), 902: (None, 5 * rng.normal(size=6)),
                903: (None, kb[10]), 904: (25, kb[10])}
    s = search_dense(*dense_frames(spark, queries, kb), k, exclude, block_rows=20, cluster_rows=15)
    same(found(s), dense_brute(queries, kb, k, exclude))


def test_rows_that_come_twice_and_queries_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(pruned, "MOST_COPIES", 0)
    rng = np.random.default_rng(5)
    m = scattered(rng, 80, 6)
    kb = spark.createDataFrame([(i % 40, m[i % 40].tolist()) for i in range(80)],
                               "id long, vec array<double>")
    q = spark.createDataFrame([(None, m[3].tolist()), (None, m[3].tolist()), (7, m[7].tolist()),
                               (7, m[7].tolist())], "query_id long, vec array<double>")
    top = search_dense(q, kb, 3, True, cluster_rows=8).top
    rows = sorted((r.query_id or -1, r["rank"], r.id) for r in top.collect())
    score = np.round(m[:40] @ m[[3, 7]].T, 9)
    other = np.argsort(-score[:, 1], kind="stable")[1]
    second = np.argsort(-score[:, 0], kind="stable")[1]
    assert rows == sorted(2 * [(-1, 1, 3), (-1, 2, 3), (-1, 3, second), (7, 1, other),
                               (7, 2, other),
                               (7, 3, np.argsort(-score[:, 1], kind="stable")[2])])


def test_stored_index_with_changes_is_streamed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(pruned, "MOST_COPIES", 0)
    rng = np.random.default_rng(8)
    kb = dict(enumerate(scattered(rng, 200, 6)))
    _, frame = dense_frames(spark, {0: (None, kb[0])}, kb)
    index = KbIndex.create(str(tmp_path / "index"), frame, pruned.DENSE, buckets=3, cluster_rows=20)
    added = {500 + i: v for i, v in enumerate(scattered(rng, 10, 6))}
    _, more = dense_frames(spark, {0: (None, kb[0])}, added)
    index = index.apply(more, frame.where("id < 5").select("id"), rebuild_share=1.0)
    live = {i: v for i, v in {**kb, **added}.items() if i >= 5}
    queries = {i: (i, kb[i]) for i in range(0, 200, 9)}
    q, _ = dense_frames(spark, queries, kb)
    same(found(index.search(numbered(q), 3)), dense_brute(queries, live, 3, True))


def test_packs_hold_bounded_rows_in_order_of_cluster_and_id(spark, monkeypatch):
    monkeypatch.setattr(packs, "PACK_BYTES", 1000)
    monkeypatch.setattr(packs, "SLICE_ROWS", 5)
    frame = spark.createDataFrame([(i % 7, i, [float(i), 1.0]) for i in range(400)],
                                  "block int, id long, vec array<double>").repartition(3)
    sizes, blocks = np.array([230, 0, 170]), np.array([4, 1, 3])
    clusters = pruned.Clusters(pruned.DENSE, np.ones((3, 2)), sizes, np.array([0, 4, 4]), blocks)
    made, n = packs.kb_packs(frame, clusters)
    rows = made.collect()
    assert 1 < n <= len(rows)
    assert max(len(r.d) for r in rows) < 1000 + 5 * 16
    for r in rows:
        assert list(zip(r.block, r.id)) == sorted(zip(r.block, r.id))
        assert all(c == (0 if b < 4 else 2) for c, b in zip(r.cluster, r.block))
        assert np.frombuffer(r.d).reshape(-1, 2)[:, 0].tolist() == list(r.id)
    assert sorted(i for r in rows for i in r.id) == [i for i in range(400) if i % 7 != 4]


def test_single_precision_misses_no_row():
    rng = np.random.default_rng(4)
    q, d = rng.normal(size=(60, 40)), rng.normal(size=(70, 40))
    d[:20] = q[:20] * rng.uniform(0.5, 2e6, size=(20, 1))
    d[20] = 1e39                                        # overflows in single precision
    (a, e), (b, f) = packs.single(q), packs.single(d)
    with np.errstate(all="ignore"):
        rough = (a @ b.T).astype(np.float64)
        far = np.abs(rough - q @ d.T) > e[:, None] * f
    assert not far[:, :20].any() and not far[:, 21:].any() and f[20] == np.inf
    best = packs.Best(np.arange(60), pa.array([None] * 60, pa.int64()), np.full(60, -np.inf),
                      pa.array([None] * 60, pa.int64()), q, None, None, 5, True)
    best.look_at(np.arange(60), np.arange(70), d)
    want = np.argsort(-np.round(q @ d.T, 9), axis=1, kind="stable")[:, :5]
    assert (best.ids == want).all()


@pytest.mark.parametrize("shape", [(1, 1), (3, 5), (16, 8), (7, 33)])
def test_places_are_those_of_nonzero(shape):
    mask = np.random.default_rng(1).random(shape) < 0.3
    assert [p.tolist() for p in packs.places(mask)] == [p.tolist() for p in np.nonzero(mask)]


def test_ties_go_to_the_lower_id_of_the_threshold():
    q = np.array([[1.0, 0.0]])
    best = packs.Best(np.array([7]), pa.array([3]), np.array([0.5]), pa.array([40]), q,
                      None, None, 2, True)
    ids = np.array([1, 3, 39, 41, 50])
    best.look_at(np.array([0]), ids, np.array([[0.5, 0], [0.9, 0], [0.5, 0], [0.5, 0], [0.7, 0]]))
    assert best.found().to_pydict() == {"row": [7, 7], "id": [50, 1], "score": [0.7, 0.5]}


@pytest.mark.parametrize("most", [0, 99])
def test_equal_rows_have_no_copies_per_block(spark, monkeypatch, written, most):
    monkeypatch.setattr(pruned, "MOST_COPIES", most)
    rng = np.random.default_rng(2)
    kb = dict(enumerate(scattered(rng, 400, 6)))
    kb |= {i: kb[0].copy() for i in range(1, 300)}
    queries = {i: (i, kb[i]) for i in range(0, 400, 2)}
    s = search_dense(*dense_frames(spark, queries, kb), 3, True, block_rows=10, cluster_rows=20)
    same(found(s), dense_brute(queries, kb, 3, True))
    assert s.clusters.blocks.max() >= 20
    # Before, a query like the others was copied to all blocks of their cluster.
    assert s.copies[0].count() <= 2 * len(queries)
    both = [{(r["row"], r["block"]) for r in c.select("row", "block").collect()} for c in s.copies]
    assert not both[0] & both[1]
