from pyspark.sql import functions as F

from replyscope.operators.retrieve import attach_cases, topk_sparse
from replyscope.operators.tfidf import fit_vocabulary, tfidf_vectors

KB = [(1, "refund for my order please", "r1", "Refund"),
      (2, "refund for my order please", "r2", "Refund"),
      (3, "password reset link expired", "r3", "Password"),
      (4, "shipping delayed tracking stuck", "r4", "Shipping"),
      (5, "charged twice on card", "r5", "Billing")]


def _kb(spark):
    return spark.createDataFrame(KB, "id long, customer_email string, support_reply string, category string")


def _run(spark, queries, k, exclude_self):
    kb = _kb(spark)
    corpus = kb.select(F.col("customer_email").alias("text"))
    vocab = fit_vocabulary(corpus, "text")
    kv = tfidf_vectors(kb, vocab, ["id"], "customer_email")
    q = spark.createDataFrame(queries, "query_id long, query_email string")
    qv = tfidf_vectors(q, vocab, ["query_id"], "query_email")
    top = topk_sparse(qv, kv, q.select("query_id"), kb.select("id"), k, exclude_self)
    return [(r.query_id, r.rank, r.id, r.score) for r in top.orderBy("query_id", "rank").collect()]


def test_no_shared_term_pads_with_lowest_ids(spark):
    rows = _run(spark, [(100, "zebra quantum")], 3, True)
    assert [(r[1], r[2], r[3]) for r in rows] == [(1, 1, 0.0), (2, 2, 0.0), (3, 3, 0.0)]


def test_k_larger_than_kb(spark):
    rows = _run(spark, [(100, "refund order")], 10, False)
    assert len(rows) == len(KB)


def test_identical_emails_tie_by_id(spark):
    rows = _run(spark, [(100, "refund for my order please")], 2, False)
    assert [r[2] for r in rows] == [1, 2]
    assert abs(rows[0][3] - 1.0) < 1e-9 and abs(rows[1][3] - 1.0) < 1e-9


def test_self_exclusion(spark):
    on = _run(spark, [(1, "refund for my order please")], 3, True)
    off = _run(spark, [(1, "refund for my order please")], 3, False)
    assert 1 not in [r[2] for r in on] and len(on) == 3
    assert 1 in [r[2] for r in off]


def test_case_lookup(spark):
    kb = _kb(spark)
    top = spark.createDataFrame([(9, 1, 3, 0.5)], "query_id long, rank int, id long, score double")
    r = attach_cases(top, kb).first()
    assert (r.customer_email, r.support_reply, r.category) == (KB[2][1], "r3", "Password")


def test_max_df_drops_common_terms(spark):
    kb = _kb(spark)
    corpus = kb.select(F.col("customer_email").alias("text"))
    full = {r.term for r in fit_vocabulary(corpus, "text").collect()}
    capped = {r.term for r in fit_vocabulary(corpus, "text", max_df=0.3).collect()}
    # "refund", "order", ... appear in 2 of 5 texts (> 30%).
    assert "refund" in full and "refund" not in capped and "password" in capped


def test_block_sizes_keep_results(spark):
    kb = _kb(spark)
    vocab = fit_vocabulary(kb.select(F.col("customer_email").alias("text")), "text")
    kv = tfidf_vectors(kb, vocab, ["id"], "customer_email")
    q = spark.createDataFrame([(100, "refund order please"), (101, "password reset")],
                              "query_id long, query_email string")
    qv = tfidf_vectors(q, vocab, ["query_id"], "query_email")
    plain = topk_sparse(qv, kv, q.select("query_id"), kb.select("id"), 3, False)
    cells = topk_sparse(qv, kv, q.select("query_id"), kb.select("id"), 3, False,
                        query_block=1, kb_block=2)
    key = lambda r: (r.query_id, r.rank, r.id, round(r.score, 12))
    assert sorted(map(key, plain.collect())) == sorted(map(key, cells.collect()))


def test_a_query_without_an_id_gets_its_cases(spark):
    kb = _kb(spark)
    vocab = fit_vocabulary(kb.select(F.col("customer_email").alias("text")), "text")
    kv = tfidf_vectors(kb, vocab, ["id"], "customer_email")
    q = spark.createDataFrame([(None, "refund order please"), (1, "refund order please")],
                              "query_id long, query_email string")
    qv = tfidf_vectors(q, vocab, ["query_id"], "query_email")
    got = topk_sparse(qv, kv, q.select("query_id"), kb.select("id"), 2, True).collect()
    assert sorted((r.query_id is None, r.rank) for r in got) == \
        [(False, 1), (False, 2), (True, 1), (True, 2)]
    assert all(r.id != 1 for r in got if r.query_id == 1)


def test_best_columns():
    import numpy as np
    from replyscope.operators.pruned import best_columns
    rng = np.random.default_rng(1)
    scores = rng.integers(0, 4, (50, 9)).astype(float)
    for k in (1, 3, 9, 12):
        want = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        assert (best_columns(scores, k) == want).all()
