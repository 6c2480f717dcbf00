import numpy as np
from pyspark.sql import functions as F

from replyscope.operators.dense import dense_cosine, encode_texts, topk_dense
from replyscope.operators.tfidf import l2_normalize


def test_l2_zero_vector_unchanged(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],)], "v array<double>")
    out = [r[0] for r in df.select(l2_normalize("v")).collect()]
    assert out[0] == [0.0, 0.0]
    assert np.allclose(out[1], [0.6, 0.8])


def _brute(vecs, k, exclude):
    ids = sorted(vecs)
    out = []
    for q in ids:
        cand = [(round(float(np.dot(vecs[q], vecs[d])), 9), d) for d in ids if not (exclude and d == q)]
        cand.sort(key=lambda t: (-t[0], t[1]))
        out += [(q, i + 1, d) for i, (_, d) in enumerate(cand[:k])]
    return out


def test_topk_dense_matches_brute_force_across_blocks(spark):
    rng = np.random.default_rng(7)
    m = rng.normal(size=(60, 8))
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    m[5] = m[6]  # an exact tie
    vecs = {i: m[i] for i in range(60)}
    df = spark.createDataFrame([(i, m[i].tolist()) for i in range(60)], "id long, vec array<double>")
    q = df.select(F.col("id").alias("query_id"), "vec")
    expected = _brute(vecs, 4, True)
    for block_rows in (1000, 7):          # one block, then many blocks per side
        got = topk_dense(q, df, 4, True, block_rows=block_rows)
        rows = [(r.query_id, r.rank, r.id) for r in got.orderBy("query_id", "rank").collect()]
        assert rows == expected


def test_dense_cosine_clamped(spark):
    df = spark.createDataFrame([([1.0, 0.0], [-1.0, 0.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(dense_cosine("a", "b")).collect()] == [0.0, 1.0]


def test_encode_texts_with_callable(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "")], "k long, t string")
    enc = lambda texts: np.array([[len(t), 1.0] for t in texts])
    rows = {r.k: r.vec for r in encode_texts(df, "k", "t", enc).collect()}
    assert np.allclose(rows[1], np.array([2.0, 1.0]) / np.sqrt(5))
    assert np.allclose(rows[2], np.array([1.0, 1.0]) / np.sqrt(2))  # blank -> " "
