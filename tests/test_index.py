"""The stored KB index: versions, deltas, no exchange of the KB."""
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.operators.index import KbIndex
from replyscope.operators.pruned import DENSE, SPARSE, _cells, _copies
from replyscope.operators.retrieve import numbered
from replyscope.operators.tfidf import gathered
from test_pruned import dense_brute, dense_frames, found, grouped, same, sparse_brute, \
    sparse_frames, topical


@pytest.fixture
def path():
    return os.path.join(tempfile.mkdtemp(prefix="replyscope-index-", dir="/tmp"), "kb")


def sparse_kb(spark, kb):
    vecs, ids = sparse_frames(spark, {0: (None, {"x": 1.0})}, kb)[1::2]
    return gathered(vecs, ids, ["id"])


def sparse_queries(spark, queries):
    qv, _, q, _ = sparse_frames(spark, queries, {0: {"x": 1.0}})
    return numbered(gathered(qv, q, ["query_id"]))


def test_deltas_equal_a_rebuild(spark, path):
    rng = random.Random(6)
    kb = topical(rng, 300)
    queries = {1000 + i: (i, kb[i]) for i in list(kb)[::9]} | {5000: (None, {})}
    q = sparse_queries(spark, queries)
    first = KbIndex.create(path, sparse_kb(spark, kb), SPARSE, buckets=4, kb_block=40,
                           cluster_rows=30)
    same(found(first.search(q, 3)), sparse_brute(queries, kb, 3, True))

    more = {100_000 + i: v for i, v in topical(random.Random(7), 25).items()}
    more[0], more[3] = {}, dict(kb[9])                      # two rows are replaced
    lost = [6, 12, 15, 100_000]
    live = {i: v for i, v in (kb | more).items() if i not in lost or i in more}
    second = first.apply(sparse_kb(spark, more),
                         spark.createDataFrame([(i,) for i in lost], "id long"))
    assert second.version == 2 and second.parts["n_delta"] == len(more)
    same(found(second.search(q, 3)), sparse_brute(queries, live, 3, True))

    # An added row is deleted again, a deleted one comes back.
    third = second.apply(sparse_kb(spark, {12: kb[12]}),
                         spark.createDataFrame([(100_003,), (999,)], "id long"))
    live = {i: v for i, v in (live | {12: kb[12]}).items() if i != 100_003}
    same(found(third.search(q, 3)), sparse_brute(queries, live, 3, True))
    rebuilt = third.apply(rebuild_share=0.0)
    assert rebuilt.version == 4 and rebuilt.parts["n_delta"] == rebuilt.parts["n_gone"] == 0
    assert rebuilt.parts["n_rows"] == len(live)
    same(found(rebuilt.search(q, 3)), sparse_brute(queries, live, 3, True))
    # Readers keep the version they opened.
    same(found(KbIndex.open(spark, path, 1).search(q, 3)), sparse_brute(queries, kb, 3, True))


def test_dense_deltas(spark, path):
    rng = np.random.default_rng(4)
    kb = dict(enumerate(grouped(rng, 200)))
    queries = {i: (i, kb[i]) for i in range(0, 200, 8)}
    more = {500 + i: v for i, v in enumerate(grouped(rng, 20, spread=0.5))}
    frame = dense_frames(spark, {0: (None, kb[0])}, kb)[1]
    index = KbIndex.create(path, frame, DENSE, buckets=3, kb_block=30, cluster_rows=20)
    index = index.apply(dense_frames(spark, {0: (None, kb[0])}, more)[1],
                        spark.createDataFrame([(8,), (9,)], "id long"))
    q = numbered(dense_frames(spark, queries, kb)[0])
    live = {i: v for i, v in (kb | more).items() if i not in (8, 9)}
    same(found(index.search(q, 4)), dense_brute(queries, live, 4, True))


def test_another_session_opens_the_last_complete_version(spark, path):
    rng = random.Random(2)
    kb = topical(rng, 60)
    q = sparse_queries(spark, {1: (None, kb[9])})
    index = KbIndex.create(path, sparse_kb(spark, kb), SPARSE, buckets=2)
    names = [t.name for t in spark.catalog.listTables() if t.name.startswith("replyscope_p")]
    for name in names:                                      # as a new session would find it
        spark.sql(f"DROP TABLE {name}")
    os.makedirs(os.path.join(path, "versions", "2"))        # begun, never finished
    opened = KbIndex.open(spark, path)
    assert opened.version == 1
    assert found(opened.search(q, 3)) == found(index.search(q, 3))
    with pytest.raises(FileNotFoundError):
        KbIndex.open(spark, path, 2)
    with pytest.raises(FileNotFoundError):
        KbIndex.open(spark, path + "-none")


def test_the_kb_side_is_not_moved(spark, path):
    rng = random.Random(8)
    kb = topical(rng, 120)
    index = KbIndex.create(path, sparse_kb(spark, kb), SPARSE, buckets=5, kb_block=20,
                           cluster_rows=40)
    index = index.apply(deleted=spark.createDataFrame([(3,)], "id long"))
    q = sparse_queries(spark, {i: (None, v) for i, v in kb.items()})
    copies = _copies(q.withColumn("least", F.lit(float("-inf"))), index.clusters,
                     lambda c, vec, _: np.ones((len(vec), len(c)), dtype=bool))
    plan = _cells(copies, index._live()[0], index.clusters, 3, False, 10_000) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "FlatMapCoGroupsInArrow" in plan
    assert plan.count("Exchange hashpartitioning(") == 1    # the queries


def test_empty_index_takes_rows(spark, path):
    index = KbIndex.create(path, spark.createDataFrame([], f"id long, vec {DENSE}"), DENSE,
                           buckets=2)
    q = numbered(spark.createDataFrame([(1, [1.0, 0.0])], f"query_id long, vec {DENSE}"))
    assert index.search(q, 3).top.collect() == []
    index = index.apply(spark.createDataFrame([(5, [0.0, 1.0]), (6, [1.0, 0.0])],
                                              f"id long, vec {DENSE}"))
    assert [(r.id, r.score) for r in index.search(q, 3).top.orderBy("rank").collect()] == \
        [(6, 1.0), (5, 0.0)]
