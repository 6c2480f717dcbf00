"""Pair metrics M1-M5 over an evaluation table.

With a vocabulary of a small bound every metric is computed in the pair's row
(``with_cosine``, ``with_alignment``, ``lcs``), so scoring shuffles nothing. The
functions that take ``pair_id`` give one row per pair; without a small bound the
sparse ones are joins on ``(pair_id, term)`` and per-pair aggregates."""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_MAX_FEATURES
from ..functions.text import bigrams, strip, unigrams, with_tfidf_terms, word_tokens
from .dense import clamp01
from .lcs import lcs_udf
from .packed import alignment, cosine, packed
from .tfidf import tfidf_vectors, with_term_counts

GEN, REF = "g", "r"
# Fixed value: an empty side is scored as one blank token.
BLANK_TOKEN = " "


def _texts(pairs: DataFrame, gen_col: str, ref_col: str) -> DataFrame:
    return (pairs.select("pair_id", F.lit(GEN).alias("side"), F.col(gen_col).alias("text"))
            .unionAll(pairs.select("pair_id", F.lit(REF).alias("side"),
                                   F.col(ref_col).alias("text"))))


def counted_sides(pairs: DataFrame, gen_col: str, ref_col: str, stop_words=None) -> DataFrame:
    """Add ``gc`` and ``rc``, both texts' terms with their counts."""
    for column, out in ((gen_col, "gc"), (ref_col, "rc")):
        pairs = with_tfidf_terms(pairs, column, "__terms", stop_words)
        pairs = with_term_counts(pairs, "__terms", out).drop("__terms")
    return pairs


def with_cosine(pairs: DataFrame, shared, gen_col: str = "generated",
                ref_col: str = "reference", stop_words=None) -> DataFrame:
    """M1 in the row: add ``cosine``. ``shared`` is a packed vocabulary."""
    counted = counted_sides(pairs, gen_col, ref_col, stop_words)
    return counted.withColumn("cosine", cosine("gc", "rc", shared)).drop("gc", "rc")


def with_words(pairs: DataFrame, column: str, words: str, terms: str, stop_words=None) -> DataFrame:
    """Add a text's metric words with their counts, one blank word for none, and
    the terms of each word as a document of its own."""
    toks = word_tokens(column)
    pairs = pairs.withColumn("__toks", F.when(F.size(toks) == 0, F.array(F.lit(BLANK_TOKEN)))
                             .otherwise(toks))
    pairs = with_term_counts(pairs, "__toks", words).drop("__toks")

    def terms_of(word: Column) -> Column:
        uni = unigrams(word["term"], stop_words)
        return F.when(F.size(uni) > 1, F.concat(uni, bigrams(uni))).otherwise(uni)

    return pairs.withColumn(terms, F.transform(words, terms_of))


def f1_of(p: Column, r: Column) -> Column:
    return F.greatest(F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r)), F.lit(0.0))


def with_alignment(pairs: DataFrame, shared, gen_col: str = "generated",
                   ref_col: str = "reference", stop_words=None) -> DataFrame:
    """M2 in the row: add ``precision``, ``recall`` and ``f1``."""
    sides = with_words(pairs, gen_col, "gw", "gt", stop_words)
    sides = with_words(sides, ref_col, "rw", "rt", stop_words)
    out = sides.withColumn("__of", alignment("gw", "gt", "rw", "rt", shared)) \
        .drop("gw", "gt", "rw", "rt")
    return (out.withColumn("precision", F.col("__of.precision"))
            .withColumn("recall", F.col("__of.recall"))
            .withColumn("f1", f1_of(F.col("precision"), F.col("recall"))).drop("__of"))


def sparse_cosine(pairs: DataFrame, vocab: DataFrame, gen_col: str = "generated",
                  ref_col: str = "reference", stop_words=None,
                  vocab_bound: int | None = DEFAULT_MAX_FEATURES) -> DataFrame:
    """M1: ``pair_id, cosine`` = TF-IDF cosine of the two texts, clamped to
    [0, 1]; 0 when either text has no known term."""
    shared = packed(vocab, vocab_bound)
    if shared is not None:
        return with_cosine(pairs.select("pair_id", gen_col, ref_col), shared, gen_col, ref_col,
                           stop_words).select("pair_id", "cosine")
    vecs = tfidf_vectors(_texts(pairs, gen_col, ref_col), vocab, ["pair_id", "side"],
                         "text", stop_words, vocab_bound)
    g = vecs.where(F.col("side") == GEN).select("pair_id", "term", F.col("w").alias("wg"))
    r = vecs.where(F.col("side") == REF).select("pair_id", "term", F.col("w").alias("wr"))
    dots = (g.join(r, ["pair_id", "term"], "inner")
            .groupBy("pair_id").agg(F.sum(F.col("wg") * F.col("wr")).alias("dot")))
    return (pairs.select("pair_id").join(dots, "pair_id", "left")
            .select("pair_id", clamp01(F.coalesce("dot", F.lit(0.0))).alias("cosine")))


def _word_rows(pairs: DataFrame, gen_col: str, ref_col: str) -> DataFrame:
    """``pair_id, side, word, cnt`` from the metric tokeniser; an empty side
    becomes one blank token."""
    t = _texts(pairs, gen_col, ref_col).select("pair_id", "side", word_tokens("text").alias("toks"))
    t = t.withColumn("toks", F.when(F.size("toks") == 0, F.array(F.lit(BLANK_TOKEN)))
                     .otherwise(F.col("toks")))
    t = with_term_counts(t, "toks", "wc")
    # Outer generator (see ``tfidf.fit_vocabulary``); every side has >= 1 token.
    return (t.select("pair_id", "side", F.inline_outer("wc")).where(F.col("term").isNotNull())
            .withColumnRenamed("term", "word"))


def token_alignment(pairs: DataFrame, vocab: DataFrame, gen_col: str = "generated",
                    ref_col: str = "reference", stop_words=None,
                    vocab_bound: int | None = DEFAULT_MAX_FEATURES) -> DataFrame:
    """M2 (offline token alignment): each word is embedded as a one-word
    TF-IDF document; precision = mean over all candidate tokens of the best
    similarity to any reference token, recall symmetric, F1 harmonic.

    Only words that share a term are compared, every other similarity is 0.
    Without a small bound for the vocabulary words are embedded once across all
    pairs (``distinct``) and meet in a ``(pair_id, term)`` join."""
    shared = packed(vocab, vocab_bound)
    if shared is not None:
        return with_alignment(pairs.select("pair_id", gen_col, ref_col), shared, gen_col, ref_col,
                              stop_words).select("pair_id", "precision", "recall", "f1")
    words = _word_rows(pairs, gen_col, ref_col)
    vocab_words = words.select(F.col("word")).distinct()
    wvec = tfidf_vectors(vocab_words, vocab, ["word"], "word", stop_words, vocab_bound)
    wv = words.select("pair_id", "side", "word").join(wvec, "word", "inner")
    g = wv.where(F.col("side") == GEN).select("pair_id", "term", F.col("word").alias("gw"),
                                              F.col("w").alias("wg"))
    r = wv.where(F.col("side") == REF).select("pair_id", "term", F.col("word").alias("rw"),
                                              F.col("w").alias("wr"))
    sim = (g.join(r, ["pair_id", "term"], "inner")
           .groupBy("pair_id", "gw", "rw").agg(F.sum(F.col("wg") * F.col("wr")).alias("sim")))
    # Best match per candidate word and per reference word in one
    # aggregation (grouping sets), so the similarity table is built once.
    best = (sim.groupingSets([["pair_id", "gw"], ["pair_id", "rw"]], "pair_id", "gw", "rw")
            .agg(F.max("sim").alias("best"), F.grouping("gw").alias("g_rolled"))
            .select("pair_id",
                    F.when(F.col("g_rolled") == 0, F.lit(GEN)).otherwise(F.lit(REF)).alias("side"),
                    F.coalesce("gw", "rw").alias("word"), "best"))
    per_side = (words.join(best, ["pair_id", "side", "word"], "left")
                .groupBy("pair_id")
                .agg((F.sum(F.when(F.col("side") == GEN, F.col("cnt") * F.coalesce("best", F.lit(0.0))))
                      / F.sum(F.when(F.col("side") == GEN, F.col("cnt")))).alias("p"),
                     (F.sum(F.when(F.col("side") == REF, F.col("cnt") * F.coalesce("best", F.lit(0.0))))
                      / F.sum(F.when(F.col("side") == REF, F.col("cnt")))).alias("r")))
    p, r_ = F.greatest(F.col("p"), F.lit(0.0)), F.greatest(F.col("r"), F.lit(0.0))
    return per_side.select("pair_id", p.alias("precision"), r_.alias("recall"),
                           f1_of(p, r_).alias("f1"))


def token_rows(pairs: DataFrame, gen_col: str = "generated",
               ref_col: str = "reference") -> DataFrame:
    """``pair_id, side, pos, word``: the metric tokens of both texts in order;
    an empty side becomes one blank token."""
    t = _texts(pairs, gen_col, ref_col).select("pair_id", "side", word_tokens("text").alias("w"))
    t = t.withColumn("w", F.when(F.size("w") == 0, F.array(F.lit(BLANK_TOKEN)))
                     .otherwise(F.col("w")))
    return t.select("pair_id", "side", F.posexplode_outer("w").alias("pos", "word"))


def token_alignment_vectors(tokens: DataFrame) -> DataFrame:
    """M3: greedy token alignment with supplied token vectors.
    Input ``pair_id, side ('g'|'r'), pos, vec`` (unit vectors); output
    ``pair_id, precision, recall, f1``. The vectors of a pair are gathered in
    one row, and Arrow batches of many pairs are scored at once; a pair's
    similarity matrix is |g| x |r| and is reduced in the task."""
    def side(name: str) -> Column:
        return F.flatten(F.collect_list(F.when(F.col("side") == name, F.col("vec"))))

    gathered = (tokens.where("vec is not null").groupBy("pair_id").agg(
        side(GEN).alias("g"), side(REF).alias("r"), F.max(F.size("vec")).alias("d")))

    @F.pandas_udf("precision double, recall double")
    def align(g: pd.Series, r: pd.Series, d: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(g), 2))
        for i, (a, b, n) in enumerate(zip(g, r, d)):
            if len(a) and len(b):
                s = np.asarray(a, dtype=np.float64).reshape(-1, n) \
                    @ np.asarray(b, dtype=np.float64).reshape(-1, n).T
                out[i] = s.max(axis=1).mean(), s.max(axis=0).mean()
        return pd.DataFrame({"precision": out[:, 0], "recall": out[:, 1]})

    p, r = F.col("of.precision"), F.col("of.recall")
    f1 = F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
    zero = F.lit(0.0)
    return gathered.select("pair_id", align("g", "r", "d").alias("of")).select(
        "pair_id", F.greatest(p, zero).alias("precision"), F.greatest(r, zero).alias("recall"),
        F.greatest(f1, zero).alias("f1"))


def with_rouge(pairs: DataFrame, gen_col: str = "generated", ref_col: str = "reference",
               prefix: str = "") -> DataFrame:
    """M4 in the row: add ``lcs, precision, recall, f1``, each name after
    ``prefix``."""
    c, r = f"{prefix}__c", f"{prefix}__r"
    lcs, p, rec = (F.col(f"{prefix}{name}") for name in ("lcs", "precision", "recall"))
    t = pairs.withColumn(c, word_tokens(gen_col)).withColumn(r, word_tokens(ref_col))
    t = t.withColumn(f"{prefix}lcs", lcs_udf(c, r))
    t = t.withColumn(f"{prefix}precision", F.when(F.size(c) > 0, lcs / F.size(c)).otherwise(0.0))
    t = t.withColumn(f"{prefix}recall", F.when(F.size(r) > 0, lcs / F.size(r)).otherwise(0.0))
    return t.withColumn(f"{prefix}f1", F.when(p + rec == 0, F.lit(0.0))
                        .otherwise(2 * p * rec / (p + rec))).drop(c, r)


def rouge_l(pairs: DataFrame, gen_col: str = "generated", ref_col: str = "reference") -> DataFrame:
    """M4: ``pair_id, lcs, precision, recall, f1`` on metric tokens."""
    return with_rouge(pairs.select("pair_id", gen_col, ref_col), gen_col, ref_col) \
        .select("pair_id", "lcs", "precision", "recall", "f1")


def coverage(ref: str | Column, cand: str | Column) -> Column:
    """M5: share of distinct reference tokens that appear in the candidate."""
    rt = F.array_distinct(word_tokens(ref))
    ct = word_tokens(strip(F.col(cand) if isinstance(cand, str) else cand))
    n = F.size(rt)
    return F.when(n > 0, F.size(F.array_intersect(rt, ct)) / n).otherwise(F.lit(0.0))
