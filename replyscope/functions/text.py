"""Text column expressions: the two tokenisers and strip. Everything here is
a built-in ``Column`` expression (JVM side)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Token patterns.
# Metric tokeniser (V1): ASCII letters, digits and the apostrophe.
WORD_PATTERN = r"[a-z0-9']+"
# TF-IDF tokeniser (V2): runs of two or more Unicode word characters.
TERM_PATTERN = r"[\p{L}\p{N}_]{2,}"

# The English stop-word list shipped with Spark ML
# (StopWordsRemover.loadDefaultStopWords("english")), in its own order.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your",
    "yours", "yourself", "yourselves", "he", "him", "his", "himself", "she",
    "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of",
    "at", "by", "for", "with", "about", "against", "between", "into",
    "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how",
    "all", "any", "both", "each", "few", "more", "most", "other", "some",
    "such", "no", "nor", "not", "only", "own", "same", "so", "than", "too",
    "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd",
    "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's",
    "we're", "they're", "i've", "we've", "you've", "they've", "isn't",
    "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't",
    "doesn't", "didn't", "won't", "wouldn't", "shan't", "shouldn't",
    "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's",
    "let's", "ought", "that's", "there's", "what's", "when's", "where's",
    "who's", "why's", "would",
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text: str | Column) -> Column:
    """V1: lower-case, then every match of ``[a-z0-9']+`` (null text -> [])."""
    t = F.coalesce(_col(text), F.lit(""))
    return F.regexp_extract_all(F.lower(t), F.lit(f"({WORD_PATTERN})"), F.lit(1))


# Fixed value: the characters that count as white space at a text's ends.
WHITE_SPACE = ("\\t\\n\\x0B\\f\\r\\x1C-\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029"
               "\\u202F\\u205F\\u3000")


def strip(text: str | Column) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only
    removes spaces)."""
    return F.regexp_replace(_col(text), f"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+$", "")


def unigrams(text: str | Column, stop_words: tuple[str, ...] | None = None) -> Column:
    """V2 unigrams: lower-case, word runs of length >= 2, stop words removed."""
    words = ENGLISH_STOP_WORDS if stop_words is None else stop_words
    t = F.coalesce(_col(text), F.lit(""))
    toks = F.regexp_extract_all(F.lower(t), F.lit(f"({TERM_PATTERN})"), F.lit(1))
    if not words:
        return toks
    # ``isin`` with many literals is planned as a hash-set lookup (InSet).
    return F.filter(toks, lambda x: ~x.isin(*words))


def bigrams(tokens: Column) -> Column:
    """Adjacent-token bigrams joined by one space. The lambda only sees its
    own arguments, so the token array is never re-evaluated per element."""
    n1 = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(F.slice(tokens, 1, n1), F.slice(tokens, 2, n1),
                      lambda a, b: F.concat(a, F.lit(" "), b))


def with_tfidf_terms(df: DataFrame, text_col: str, out_col: str,
                     stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """V2: add ``out_col`` with all uni- and bi-gram terms of a text, in
    order (stop words removed before bigrams are formed). The unigrams are a
    column of their own, referenced several times, so the optimizer keeps
    them computed once per row."""
    uni = "__uni"
    df = df.withColumn(uni, unigrams(text_col, stop_words))
    return df.withColumn(out_col, F.concat(F.col(uni), bigrams(F.col(uni)))).drop(uni)
