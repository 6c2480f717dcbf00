"""Frequent terms from bounded summaries against counting everything."""
import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from replyscope.operators.frequent import Summary, frequent_terms
from replyscope.operators.tfidf import counted, vocabulary_from_counts, vocabulary_from_rows, \
    exploded


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 30), st.integers(1, 5)), max_size=20),
                max_size=12), st.integers(1, 12))
def test_summary_bounds(batches, counters):
    held, true, texts = Summary(counters), Counter(), Counter()
    for batch in batches:
        held.add(pa.array([str(t) for t, _ in batch], pa.string()),
                 pa.array([c for _, c in batch], pa.int32()))
        for t, c in batch:
            true[str(t)] += c
            texts[str(t)] += 1
    got = dict(zip(held.table["term"].to_pylist(), held.table["tf"].to_pylist()))
    df = dict(zip(held.table["term"].to_pylist(), held.table["df"].to_pylist()))
    assert len(got) <= counters
    assert held.error * (counters + 1) <= sum(true.values())
    for t, n in true.items():
        assert got.get(t, 0) <= n <= got.get(t, 0) + held.error
        assert df.get(t, 0) <= texts[t] <= df.get(t, 0) + held.error


def corpus_of(spark, n, seed, spread):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    weights = [1.0 / (i + 1) ** spread for i in range(400)]
    rows = [(" ".join(rng.choices(words, weights, k=rng.randint(0, 40))),) for _ in range(n)]
    return counted(spark.createDataFrame(rows + [(None,)], "text string").repartition(4), [], "text")


@pytest.mark.parametrize("n, counters, how", [(20, 1 << 17, "summaries"), (8, 100, "candidates"),
                                              (300, 60, "all")])
@pytest.mark.parametrize("most", [None, 60.0])
def test_equals_counting_everything(spark, n, counters, how, most):
    counts = corpus_of(spark, 300, 1, 1.6).cache()
    true, texts = Counter(), Counter()
    for r in counts.collect():
        for e in r.tc:
            true[e.term] += e.cnt
            texts[e.term] += 1
    want = sorted(((-c, t, texts[t]) for t, c in true.items()
                   if most is None or texts[t] <= most))[:n]
    stats, path = frequent_terms(counts, n, most, counters)
    got = sorted((-r.tf, r.term, r.df) for r in stats.collect())[:n]
    assert got == want
    assert path == how or most is not None


def test_vocabulary_is_the_same(spark):
    counts = corpus_of(spark, 200, 2, 1.2).cache()
    total = counts.count()
    from pyspark.sql import functions as F
    for features, max_df in ((50, None), (50, 0.2), (10 ** 6, None)):
        a = vocabulary_from_counts(counts, features, max_df).collect()
        b = vocabulary_from_rows(exploded(counts, []), F.lit(total), features, max_df).collect()
        assert sorted(a) == sorted(b) and len(a) > 10
