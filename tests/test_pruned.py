"""Pruned exact search: the same rows as scoring everything, less work."""
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from replyscope.operators.dense import search_dense
from replyscope.operators.pruned import SLOTS, Clusters, DENSE, angles
from replyscope.operators.retrieve import search_sparse


def sparse_brute(queries, kb, k, exclude):
    """``{query: [(id, score)]}`` by scoring every pair."""
    out = {}
    for key, (own, q) in queries.items():
        scored = []
        for i, d in kb.items():
            if not (exclude and own == i):
                scored.append((-round(sum(w * d.get(t, 0.0) for t, w in q.items()), 9), i))
        out[key] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def unit(weights):
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()} if norm else {}


def topical(rng, n, topics=12, words=15):
    """Texts of one topic each, with a few words that all share."""
    out = {}
    for i in range(n):
        t = rng.randrange(topics)
        picked = [f"t{t}w{rng.randrange(words)}" for _ in range(rng.randint(4, 9))]
        picked += [f"common{rng.randrange(3)}" for _ in range(2)]
        bag = defaultdict(float)
        for w in picked:
            bag[w] += 0.2 if w.startswith("common") else 1.0
        out[i * 3] = unit(bag)
    return out


def sparse_frames(spark, queries, kb):
    vecs = spark.createDataFrame([(i, t, w) for i, v in kb.items() for t, w in v.items()],
                                 "id long, term string, w double")
    qv = spark.createDataFrame([(i, t, w) for i, (_, v) in queries.items() for t, w in v.items()],
                               "query_id long, term string, w double")
    q = spark.createDataFrame([(i, own) for i, (own, _) in queries.items()],
                              "query_id long, self_id long")
    return qv, vecs, q, spark.createDataFrame([(i,) for i in kb], "id long")


def found(search, decimals=9):
    out = defaultdict(list)
    for r in search.top.orderBy("query_id", "rank").collect():
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.id, round(r.score, decimals)))
    return dict(out)


def same(got, want):
    assert got.keys() == want.keys()
    for key in want:
        assert [i for i, _ in got[key]] == [i for i, _ in want[key]], key
        assert np.allclose([s for _, s in got[key]], [s for _, s in want[key]], atol=2e-9)


@pytest.mark.parametrize("k, exclude", [(3, True), (1, False), (40, True)])
def test_sparse_equals_scoring_everything(spark, k, exclude):
    rng = random.Random(k)
    kb = topical(rng, 400)
    kb[5], kb[7], kb[8] = dict(kb[6]), dict(kb[6]), {}          # ties and an empty row
    queries = {1000 + i: (i, kb[i]) for i in list(kb)[::7]}
    queries |= {5000: (None, {}), 5001: (None, {"unknown": 1.0}), 5002: (6, kb[6]),
                5003: (None, unit({"common0": 1.0}))}
    # 40 crowded copies of one query: its block is copied per cell.
    queries |= {6000 + i: (None, kb[9]) for i in range(40)}
    s = search_sparse(*sparse_frames(spark, queries, kb), k, exclude, query_block=16, kb_block=30,
                      cluster_rows=25)
    same(found(s), sparse_brute(queries, kb, k, exclude))


def test_sparse_skips_cells_of_other_topics(spark):
    rng = random.Random(3)
    kb = topical(rng, 600)
    queries = {i: (i, v) for i, v in topical(random.Random(4), 200).items()}
    frames = sparse_frames(spark, queries, kb)
    s = search_sparse(*frames, 3, False, kb_block=1000, cluster_rows=20)
    assert len(s.clusters) == 30
    same(found(s), sparse_brute(queries, kb, 3, False))
    # Of 200 x 600 pairs; a topic holds a twelfth of the rows, and every query
    # shares a common word with other topics, too.
    assert s.scored_pairs() < 0.5 * len(queries) * len(kb)
    copies = sum(c.count() for c in s.copies)
    assert copies < 0.6 * len(queries) * s.clusters.total_blocks


def test_one_cluster_needs_no_second_look(spark):
    rng = random.Random(5)
    kb = topical(rng, 50)
    queries = {i: (i, v) for i, v in kb.items()}
    s = search_sparse(*sparse_frames(spark, queries, kb), 3, True)
    assert len(s.copies) == 1 and s.clusters.total_blocks == 1
    same(found(s), sparse_brute(queries, kb, 3, True))


def test_block_max_bounds_every_row():
    rng = np.random.default_rng(2)
    import pyarrow as pa
    kind = pa.list_(pa.struct([("term", pa.int64()), ("w", pa.float64())]))
    rows = [[{"term": int(t), "w": float(rng.random())} for t in rng.integers(-2**60, 2**60, 6)]
            for _ in range(30)]
    for r in rows[10:20]:
        r[0]["term"] = rows[0][0]["term"]
    peaks = np.zeros((3, SLOTS))
    for i, r in enumerate(rows):
        for e in r:
            at = i % 3, e["term"] % SLOTS
            peaks[at] = max(peaks[at], e["w"])
    c = Clusters("array<struct<term:bigint,w:double>>", peaks, np.full(3, 10), peaks=peaks)
    bound = c.upper(pa.array(rows, type=kind))
    for i, q in enumerate(rows):
        for j, d in enumerate(rows):
            score = sum(a["w"] * b["w"] for a in q for b in d if a["term"] == b["term"])
            assert score <= bound[i, j % 3] + 1e-12


def dense_brute(queries, kb, k, exclude):
    out = {}
    for key, (own, q) in queries.items():
        scored = sorted((-round(float(q @ d), 9), i) for i, d in kb.items()
                        if not (exclude and own == i))
        out[key] = [(i, -s) for s, i in scored[:k]]
    return out


def grouped(rng, n, groups=10, width=6, spread=0.05):
    centre = rng.normal(size=(groups, width))
    m = centre[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, width))
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def dense_frames(spark, queries, kb):
    q = spark.createDataFrame([(i, own, v.tolist()) for i, (own, v) in queries.items()],
                              "query_id long, self_id long, vec array<double>")
    return q, spark.createDataFrame([(i, v.tolist()) for i, v in kb.items()],
                                    "id long, vec array<double>")


@pytest.mark.parametrize("k, exclude", [(3, True), (25, False)])
def test_dense_equals_scoring_everything(spark, k, exclude):
    rng = np.random.default_rng(k)
    kb = dict(enumerate(grouped(rng, 300)))
    kb[4] = kb[5].copy()
    kb[6] = np.zeros(6)                                 # no direction
    kb[7] = 3.0 * kb[8]                                 # not of unit length
    queries = {i: (i, kb[i]) for i in range(0, 300, 3)}
    queries |= {900: (None, np.zeros(6)), 901: (None, -kb[10]), 902: (None, rng.normal(size=6))}
    s = search_dense(*dense_frames(spark, queries, kb), k, exclude, block_rows=20, cluster_rows=15)
    assert len(s.clusters) == 20 and len(s.copies) == 2
    same(found(s), dense_brute(queries, kb, k, exclude))


def test_dense_copies_stay_below_the_blocks(spark):
    rng = np.random.default_rng(1)
    kb = dict(enumerate(grouped(rng, 800, groups=20, spread=0.02)))
    queries = {i: (None, v) for i, v in kb.items() if i % 4 == 0}
    s = search_dense(*dense_frames(spark, queries, kb), 3, False, cluster_rows=40)
    same(found(s), dense_brute(queries, kb, 3, False))
    copies = sum(c.count() for c in s.copies) / len(queries)
    assert copies < 0.5 * s.clusters.total_blocks


def test_triangle_bound_holds_for_every_row(spark):
    rng = np.random.default_rng(9)
    rows = grouped(rng, 200, spread=0.3)
    pivots = rows[:8]
    home = angles(rows, pivots).argmin(axis=1)
    from replyscope.operators.pruned import measure
    df = spark.createDataFrame([(r.tolist(), int(h)) for r, h in zip(rows, home)],
                               "vec array<double>, cluster int").repartition(5)
    import pyarrow as pa
    c = measure(df, Clusters(DENSE, pivots))
    bound = c.upper(pa.array([r.tolist() for r in rows]))
    assert (bound[:, home] + 1e-9 >= rows @ rows.T).all()


def test_id_less_queries_are_told_apart_by_a_row_key(spark):
    rng = np.random.default_rng(3)
    kb = dict(enumerate(grouped(rng, 40)))
    q = spark.createDataFrame([(None, kb[3].tolist()), (None, kb[20].tolist())],
                              "query_id long, vec array<double>")
    _, frame = dense_frames(spark, {0: (None, kb[0])}, kb)
    top = search_dense(q, frame, 2, True).top
    first = sorted(r.id for r in top.where("rank = 1").collect())
    assert first == [3, 20] and top.count() == 4


def test_empty_sides(spark):
    empty_kb = spark.createDataFrame([], "id long, vec array<double>")
    q = spark.createDataFrame([(1, [1.0, 0.0])], "query_id long, vec array<double>")
    kb = spark.createDataFrame([(1, [1.0, 0.0])], "id long, vec array<double>")
    assert search_dense(q, empty_kb, 3).top.collect() == []
    assert search_dense(q.limit(0), kb, 3).top.collect() == []
    assert search_dense(q, kb, 0, False).top.collect() == []
    assert search_dense(q, kb, 3, True).top.collect() == []
