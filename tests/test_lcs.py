from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from replyscope.operators.lcs import lcs_length
from replyscope.operators.metrics import rouge_l


def subsequences(tokens):
    """Every subsequence, as a set of tuples."""
    found = {()}
    for t in tokens:
        found |= {s + (t,) for s in found}
    return found


@given(st.lists(st.sampled_from("abcd"), max_size=9), st.lists(st.sampled_from("abcd"), max_size=9))
@settings(max_examples=300, deadline=None)
def test_bit_parallel_matches_all_subsequences(a, b):
    assert lcs_length(a, b) == max(map(len, subsequences(a) & subsequences(b)))


@given(st.lists(st.sampled_from("abcde"), max_size=90), st.lists(st.sampled_from("abcde"), max_size=90),
       st.sampled_from("abcde"))
@settings(max_examples=200, deadline=None)
def test_lcs_laws(a, b, t):
    n = lcs_length(a, b)
    assert n == lcs_length(b, a) == lcs_length(a[::-1], b[::-1]) and n <= min(len(a), len(b))
    assert lcs_length(a + [t], b + [t]) == n + 1 and lcs_length(a, a + b) == len(a)


def test_hand_cases():
    assert lcs_length("a b c d".split(), "a c d b".split()) == 3
    assert lcs_length("a a b a".split(), "a b a a".split()) == 3
    assert lcs_length("the cat sat on the mat".split(), "the mat sat on the cat".split()) == 4
    assert lcs_length([], ["a"]) == 0


def _rouge(spark, gen, ref):
    df = spark.createDataFrame([(1, gen, ref)], "pair_id long, generated string, reference string")
    return rouge_l(df).first()


def test_rouge_prf(spark):
    r = _rouge(spark, "a b c d", "a c d b")
    assert r.lcs == 3 and abs(r.precision - 0.75) < 1e-12 and abs(r.recall - 0.75) < 1e-12
    assert abs(r.f1 - 0.75) < 1e-12


def test_rouge_empty_side(spark):
    r = _rouge(spark, "", "a b")
    assert (r.lcs, r.precision, r.recall, r.f1) == (0, 0.0, 0.0, 0.0)
