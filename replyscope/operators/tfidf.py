"""V3-V5: TF-IDF vocabulary fit and sparse unit-length vectors.

A text's vector is one row, ``vec`` (``whole_vectors``), or one row per term,
``(key..., term, w)`` (``tfidf_vectors``). With a vocabulary of a small bound
both are made where the text is (``packed``), without a shuffle."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_MAX_FEATURES
from ..functions.text import with_tfidf_terms
from ..session import small, spread
from .frequent import frequent_terms
from .packed import packed, vector


def with_term_counts(df: DataFrame, terms_col: str, out_col: str) -> DataFrame:
    """Add ``out_col ARRAY<STRUCT<term, cnt>>``: the distinct terms of
    ``terms_col`` with their counts, computed inside the row (no shuffle).

    Sort once, mark where each run of equal terms starts, and take the
    distance between consecutive starts. The sorted array is a column of its
    own so no lambda recomputes it."""
    srt, prev, starts, nxt = "__srt", "__prev", "__starts", "__next"
    n = F.size(F.col(srt))
    df = df.withColumn(srt, F.sort_array(F.col(terms_col)))
    df = df.withColumn(prev, F.concat(F.array(F.lit(None).cast("string")),
                                      F.slice(F.col(srt), 1, F.greatest(n - 1, F.lit(0)))))
    zipped = F.arrays_zip(F.col(srt), F.col(prev))
    df = df.withColumn(starts, F.filter(
        F.transform(zipped, lambda z, i: F.when(z[srt].eqNullSafe(z[prev]), F.lit(-1))
                    .otherwise(i + 1)),
        lambda p: p > 0))
    m = F.size(F.col(starts))
    df = df.withColumn(nxt, F.concat(F.slice(F.col(starts), 2, F.greatest(m - 1, F.lit(0))),
                                     F.array(n + 1)))
    counts = F.transform(F.arrays_zip(F.col(starts), F.col(nxt)),
                         lambda z: (z[nxt] - z[starts]).cast("int"))
    pairs = F.arrays_zip(F.array_distinct(F.col(srt)).alias("term"), counts.alias("cnt"))
    empty = F.array().cast("array<struct<term:string,cnt:int>>")
    df = df.withColumn(out_col, F.when(n > 0, pairs.cast("array<struct<term:string,cnt:int>>"))
                       .otherwise(empty))
    return df.drop(srt, prev, starts, nxt)


def vocabulary_from_rows(rows: DataFrame, n_docs: Column,
                         max_features: int | None = DEFAULT_MAX_FEATURES,
                         max_df: float | None = None) -> DataFrame:
    """V3 from term rows ``(..., term, cnt)`` (one row per distinct term of a
    text) and the number of texts ``n_docs`` (a scalar column).

    One partially aggregated ``groupBy(term)``: term frequency is the sum of
    counts, document frequency the number of rows; a hot term is collapsed
    map-side. The top-N is a bounded TakeOrderedAndProject (ties by term).
    ``max_df`` (off by default because it changes scores) drops terms found
    in more than that share of texts before the top-N cut; such terms are
    the ones whose postings make the retrieval join quadratic."""
    stats = (rows.groupBy("term")
             .agg(F.sum("cnt").cast("bigint").alias("tf"),
                  F.count(F.lit(1)).cast("bigint").alias("df")))
    if max_df is not None:
        stats = stats.where(F.col("df") <= F.lit(float(max_df)) * n_docs)
    if max_features is not None:
        stats = stats.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return stats.select("term", "tf", "df", idf.alias("idf"))


def fit_vocabulary(docs: DataFrame, text_col: str = "text",
                   max_features: int | None = DEFAULT_MAX_FEATURES,
                   stop_words: tuple[str, ...] | None = None,
                   max_df: float | None = None) -> DataFrame:
    """V3: ``term, tf, df, idf`` for the ``max_features`` most frequent terms
    of the corpus, ``idf = ln((1 + N) / (1 + df)) + 1``. Terms are counted
    inside each text first (no shuffle); see ``vocabulary_from_rows``."""
    return vocabulary_from_counts(counted(docs, [], text_col, stop_words), max_features, max_df)


def vocabulary_from_counts(counts: DataFrame, max_features: int | None = DEFAULT_MAX_FEATURES,
                           max_df: float | None = None) -> DataFrame:
    """V3 from ``counted`` texts. With ``max_features`` the terms are found by
    bounded summaries (``frequent``); without it all of them are counted."""
    if max_features is None:
        return vocabulary_from_rows(exploded(counts, []), counts.select(F.count(F.lit(1))).scalar(),
                                    None, max_df)
    n = counts.count()
    stats, _ = frequent_terms(counts, max_features, None if max_df is None else max_df * n)
    stats = stats.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    idf = F.log((F.lit(1.0) + F.lit(float(n))) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return stats.select("term", "tf", "df", idf.alias("idf"))


def term_rows(docs: DataFrame, key_cols: list[str], text_col: str,
              stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """``key..., term, cnt``: one row per distinct term of each text.

    ``inline_outer`` plus a null filter instead of ``inline``: for an inner
    generator the optimizer infers ``size(array) > 0`` and pushes it below
    the projections with the whole tokenising expression inlined, which
    evaluates it several times per row."""
    return exploded(counted(docs, key_cols, text_col, stop_words), key_cols)


def counted(docs: DataFrame, key_cols: list[str], text_col: str,
            stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """``key..., tc``: each text with its distinct terms and their counts."""
    t = spread(docs.select(*key_cols, F.col(text_col).alias("__text")))
    t = with_tfidf_terms(t, "__text", "__terms", stop_words).drop("__text")
    return with_term_counts(t, "__terms", "tc").select(*key_cols, "tc")


def exploded(counts: DataFrame, key_cols: list[str]) -> DataFrame:
    """``key..., term, cnt`` of ``counted`` texts."""
    return counts.select(*key_cols, F.inline_outer("tc")).where(F.col("term").isNotNull())


def vectors_from_counts(counts: DataFrame, vocab: DataFrame, key_cols: list[str],
                        vocab_bound: int | None = DEFAULT_MAX_FEATURES) -> DataFrame:
    """V4 + V5 of ``counted`` texts: ``key..., term, w``."""
    shared = packed(vocab, vocab_bound)
    if shared is None:
        return vectors_from_rows(exploded(counts, key_cols), vocab, key_cols, vocab_bound)
    held = counts.select(*key_cols, vector("tc", shared, names=True).alias("vec"))
    return held.select(*key_cols, F.inline("vec"))


def whole_vectors(counts: DataFrame, vocab: DataFrame, key_cols: list[str],
                  vocab_bound: int | None = DEFAULT_MAX_FEATURES) -> DataFrame:
    """V4 + V5 of ``counted`` texts: ``key..., vec`` with one row per text. Terms
    are numbers of the vocabulary; without a small bound for it they are 64-bit
    hashes (among a million terms two collide with a chance below 1e-7), and
    rows of one key count as one text."""
    shared = packed(vocab, vocab_bound)
    if shared is not None:
        return counts.select(*key_cols, vector("tc", shared).alias("vec"))
    return gathered(vectors_from_rows(exploded(counts, key_cols), vocab, key_cols, vocab_bound),
                    counts.select(*key_cols), key_cols)


def gathered(vecs: DataFrame, keys: DataFrame, key_cols: list[str]) -> DataFrame:
    """The rows of ``keys`` with their long-form vectors as one array each; a
    text without known terms has an empty one."""
    whole = vecs.groupBy(*[F.col(c).alias(f"__{c}") for c in key_cols]).agg(
        F.collect_list(F.struct(F.xxhash64("term").alias("term"),
                                F.col("w").cast("double").alias("w"))).alias("vec"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key_cols])
    kind = "array<struct<term:bigint,w:double>>"
    return keys.join(whole, same, "left").select(
        *keys.columns, F.coalesce(F.col("vec").cast(kind), F.array().cast(kind)).alias("vec"))


def vectors_from_rows(rows: DataFrame, vocab: DataFrame, key_cols: list[str],
                      vocab_bound: int | None = DEFAULT_MAX_FEATURES) -> DataFrame:
    """V4 + V5 from term rows ``(key..., term, cnt)``: ``key..., term, w``
    with ``w = cnt * idf`` scaled to unit length per text. Out-of-vocabulary
    terms are dropped; a text with no known term has no rows (the zero
    vector). The vocabulary is broadcast when its size has a small bound
    (``max_features`` rows); the only shuffle is the norm window, over
    distinct in-vocabulary (text, term) rows."""
    v = vocab.select("term", "idf")
    if small(vocab_bound):
        v = F.broadcast(v)
    joined = rows.select(*key_cols, "term", "cnt").join(v, "term", "inner")
    raw = (F.col("cnt") * F.col("idf"))
    norm = F.sqrt(F.sum(raw * raw).over(Window.partitionBy(*key_cols)))
    return joined.select(*key_cols, "term", (raw / norm).alias("w"))


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, key_cols: list[str],
                  text_col: str, stop_words: tuple[str, ...] | None = None,
                  vocab_bound: int | None = DEFAULT_MAX_FEATURES) -> DataFrame:
    """V4 + V5 for raw texts: tokenise and count in the row, then
    ``vectors_from_counts``."""
    return vectors_from_counts(counted(docs, key_cols, text_col, stop_words), vocab, key_cols,
                               vocab_bound)


def l2_normalize(vec: str | Column) -> Column:
    """V5 on a dense ``ARRAY<FLOAT|DOUBLE>``: divide by the L2 norm; a zero
    vector stays zero. Result is ``ARRAY<DOUBLE>``."""
    v = F.col(vec) if isinstance(vec, str) else vec
    # The division happens in the finish function, so the norm is computed
    # once per row rather than once per element.
    return F.aggregate(
        v, F.lit(0.0).cast("double"),
        lambda acc, x: acc + x.cast("double") * x.cast("double"),
        lambda acc: F.transform(v, lambda x: x.cast("double") / F.when(acc == 0, F.lit(1.0))
                                .otherwise(F.sqrt(acc))))
