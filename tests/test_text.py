from pyspark.sql import functions as F

from replyscope.functions.text import unigrams, with_tfidf_terms, word_tokens
from replyscope.operators.tfidf import with_term_counts


def test_word_tokens_ascii_only(spark):
    df = spark.createDataFrame([("Hi, I've sent 4K naïve",)], "t string")
    assert df.select(word_tokens("t")).first()[0] == ["hi", "i've", "sent", "4k", "na", "ve"]


def test_word_tokens_null_is_empty(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(word_tokens("t")).first()[0] == []


def test_unigrams_drop_stop_words_and_short_runs(spark):
    df = spark.createDataFrame([("The café is 4K a b naïve_x",)], "t string")
    assert df.select(unigrams("t")).first()[0] == ["café", "4k", "naïve_x"]


def test_bigrams_after_stop_words(spark):
    df = spark.createDataFrame([("refund the order now please",), ("one",), ("",)], "t string")
    out = [r[0] for r in with_tfidf_terms(df, "t", "terms").select("terms").collect()]
    # "the" and "now" are stop words: removed before bigrams are formed.
    assert out[0] == ["refund", "order", "please", "refund order", "order please"]
    assert out[1] == ["one"]
    assert out[2] == []


def test_term_counts_in_row(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c", "a", "b"],), ([],)], "t array<string>")
    rows = with_term_counts(df, "t", "tc").select("tc").collect()
    assert [(r.term, r.cnt) for r in rows[0][0]] == [("a", 2), ("b", 3), ("c", 1)]
    assert rows[1][0] == []
