"""Dense vectors: pluggable encoding (V6), exact top-k (R2 dense) and
pairwise dense cosine (M1 dense).

Exact search deals the KB to clusters around pivots and skips those that the
triangle inequality rules out (``pruned``); a block of KB rows and its queries
are two bounded matrices whose product keeps the k best per query. No (query,
KB) pair becomes a row."""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import Scratch
from .pruned import CLUSTER_ROWS, DENSE, KB_BLOCK, QUERY_BLOCK, Search, build, search
from .retrieve import numbered
from .runner import ModelRunner, run_model
from .tfidf import l2_normalize


def search_dense(queries: DataFrame, kb: DataFrame, k: int, exclude_self: bool = True,
                 block_rows: int | None = None, cluster_rows: int = CLUSTER_ROWS) -> Search:
    """``topk_dense`` with its tables of query copies."""
    whole = Scratch.of(kb.sparkSession).table(kb.select("id", F.col("vec").cast(DENSE).alias("vec")))
    blocks, clusters = build(whole, DENSE, block_rows or KB_BLOCK, cluster_rows)
    q = numbered(queries.withColumn("vec", F.col("vec").cast(DENSE)))
    return search(q, [blocks], whole, clusters, k, exclude_self, block_rows or QUERY_BLOCK)


def topk_dense(queries: DataFrame, kb: DataFrame, k: int, exclude_self: bool = True,
               block_rows: int | None = None, cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """R2 (dense) + R3. ``queries(query_id, vec)``, ``kb(id, vec)``; output
    ``query_id, rank, id, score`` ranked by (score desc, id asc). ``queries``
    may name the own row in a column ``self_id``; otherwise it is ``query_id``,
    and a query without one has no row to leave out."""
    return search_dense(queries, kb, k, exclude_self, block_rows, cluster_rows).top \
        .select("query_id", "rank", "id", "score")


def dot(a: str | Column, b: str | Column) -> Column:
    """Row-wise inner product of two equal-length numeric arrays."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(ca, cb, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def clamp01(c: Column) -> Column:
    return F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0))


def dense_cosine(a: str | Column, b: str | Column) -> Column:
    """M1 (dense): dot of unit vectors clamped to [0, 1]."""
    return clamp01(dot(a, b))


Encoder = Callable[[list[str]], np.ndarray]


def encode_texts(df: DataFrame, key_col: str, text_col: str, encoder: Encoder | ModelRunner,
                 blank_as_space: bool = True) -> DataFrame:
    """V6: encode texts and L2-normalise the vectors. Output
    ``key, vec ARRAY<DOUBLE>``.

    ``encoder(list[str]) -> (n, d) array`` is called on Arrow batches; a
    ``ModelRunner`` brings set-up, batches, retries and a journal. A text that
    a runner fails to encode stops the job: a missing vector would silently
    change every ranking."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    if blank_as_space:
        text = F.when(strip(text) == "", F.lit(" ")).otherwise(text)
    rows = df.select(F.col(key_col).alias("key"), text.alias("text"))
    if isinstance(encoder, ModelRunner):
        raw = run_model(rows, "key", "text", encoder, "array<double>").select(
            F.col("key").alias(key_col),
            F.when(F.col("error").isNull(), F.col("value"))
            .otherwise(F.raise_error(F.concat(F.lit("text not encoded: "), F.col("error")))
                       .cast("array<double>")).alias("vec"))
        return raw.select(key_col, l2_normalize("vec").alias("vec"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            mat = np.asarray(encoder(texts), dtype=np.float64) if texts else np.zeros((0, 0))
            yield pd.DataFrame({key_col: pdf["key"].to_numpy(),
                                "vec": list(mat) if len(texts) else []})
    key_type = df.schema[key_col].dataType.simpleString()
    raw = rows.mapInPandas(run, schema=f"{key_col} {key_type}, vec array<double>")
    return raw.select(key_col, l2_normalize("vec").alias("vec"))
