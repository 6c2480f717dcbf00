"""Vectors, cosine and alignment in the row against the joined forms and against
plain Python."""
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.operators import packed as module
from replyscope.operators.metrics import sparse_cosine, token_alignment
from replyscope.operators.tfidf import counted, fit_vocabulary, tfidf_vectors, whole_vectors
from replyscope.plans.evaluate import evaluate, pair_vocabulary
from replyscope.sources.tables import eval_pairs

ODD = [(1, "Order order it's I've it's-it's", "the order is it's"), (2, "", ""), (3, None, "x"),
       (4, "zz unknown", "zz unknown zz"), (5, "refund refund card", "card refund"),
       (6, "été 4K naïve order", "order 4K"), (7, "order " * 5000, "order card " * 3000)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "pair_id long, generated string, reference string")


@pytest.fixture(scope="module")
def vocab(spark, odd):
    texts = odd.where("pair_id not in (4, 7)").select(F.explode(F.array("generated", "reference"))
                                                      .alias("text"))
    return fit_vocabulary(texts).cache()


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_vectors_equal_the_joined_ones(spark, odd, vocab):
    docs = odd.select("pair_id", F.col("generated").alias("text"))
    joined = rows(tfidf_vectors(docs, vocab, ["pair_id"], "text", vocab_bound=None),
                  "pair_id", "term")
    here = rows(tfidf_vectors(docs, vocab, ["pair_id"], "text"), "pair_id", "term")
    assert here.keys() == joined.keys() and len(here) > 10
    assert all(math.isclose(here[k].w, joined[k].w, rel_tol=1e-12) for k in here)
    whole = rows(whole_vectors(counted(docs, ["pair_id"], "text"), vocab, ["pair_id"]), "pair_id")
    assert len(whole) == len(ODD) and whole[2,].vec == [] and whole[3,].vec == []
    terms = sorted(r.term for r in vocab.collect())
    for (pair_id,), r in whole.items():
        assert {(terms[e.term], round(e.w, 12)) for e in r.vec} == \
            {(k[1], round(v.w, 12)) for k, v in joined.items() if k[0] == pair_id}
        assert not r.vec or math.isclose(sum(e.w ** 2 for e in r.vec), 1.0, rel_tol=1e-12)
    plan = whole_vectors(counted(docs, ["pair_id"], "text"), vocab, ["pair_id"]) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("entries", [1 << 20, 7])
def test_metrics_equal_the_joined_ones(spark, sf, odd, vocab, entries, monkeypatch):
    monkeypatch.setattr(module, "SLICE_ENTRIES", entries)
    given = eval_pairs(spark, sf).select(F.col("id").alias("pair_id"), "generated", "reference")
    for pairs, v in ((odd, vocab), (given, pair_vocabulary(eval_pairs(spark, sf)).cache())):
        a, b = (rows(sparse_cosine(pairs, v, vocab_bound=x), "pair_id") for x in (None, 4096))
        assert a.keys() == b.keys()
        assert np.allclose([a[k].cosine for k in a], [b[k].cosine for k in a], atol=1e-12)
        a, b = (rows(token_alignment(pairs, v, vocab_bound=x), "pair_id") for x in (None, 4096))
        assert a.keys() == b.keys()
        for name in ("precision", "recall", "f1"):
            assert np.allclose([a[k][name] for k in a], [b[k][name] for k in a], atol=1e-12), name


def test_alignment_of_one_word_vectors_by_hand(spark):
    vocab = spark.createDataFrame([("aa", 2.0), ("bb", 1.0), ("aa bb", 3.0)],
                                  "term string, idf double")
    pairs = spark.createDataFrame([(1, "aa aa cc", "aa bb"), (2, "cc", "dd")],
                                  "pair_id long, generated string, reference string")
    got = rows(token_alignment(pairs, vocab), "pair_id")
    assert (got[1,].precision, got[1,].recall) == (2 / 3, 1 / 2)
    assert (got[2,].precision, got[2,].recall, got[2,].f1) == (0.0, 0.0, 0.0)


def test_scoring_moves_no_rows_and_keeps_pairs_without_an_id(spark):
    pairs = spark.createDataFrame(
        [(None, "a", "where is it", "it is here", "it is here now"),
         (None, "b", "refund please", "", "refund sent"), (7, "a", "hello", "hello there", None),
         (7, None, "hello", "card lost", "card lost")],
        "id long, category string, customer_email string, generated string, reference string")
    vocab = fit_vocabulary(pairs.select(F.col("reference").alias("text"))).cache()
    scores = evaluate(pairs, vocab)
    # A small table may be dealt over the cores, but nothing moves by a key.
    assert "hashpartitioning" not in scores._jdf.queryExecution().executedPlan().toString()
    assert Counter(r.id for r in scores.collect()) == {None: 2, 7: 2}
    judged = evaluate(pairs, vocab, judge=lambda s, u, t, m: '{"tone": 5}', judge_backend="j")
    assert [(r.tone, r.judge_backend) for r in judged.collect()] == [(5, "j")] * 4


def test_generate_answers_queries_without_an_id(spark):
    from replyscope.plans.generate import generate
    kb = spark.createDataFrame([(1, "refund for my order", "r1", "A"), (2, "reset password", "r2", "B"),
                                (3, "card charged twice", "r3", "C")],
                               "id long, customer_email string, support_reply string, category string")
    q = spark.createDataFrame([(None, "password reset"), (None, "my card"), (1, "refund order")],
                              "query_id long, query_email string")
    for model in (None, lambda system, user, t, m: user[-5:]):
        out = {r.query_email: r for r in generate(q, kb, complete=model)[0].collect()}
        assert {k: (r.query_id, r.retrieved[0].id) for k, r in out.items()} == \
            {"password reset": (None, 2), "my card": (None, 3), "refund order": (1, 2)}
        assert all(len(r.retrieved) == (2 if r.query_id else 3) for r in out.values())
