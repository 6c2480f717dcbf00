"""Leakage-safe knowledge-base / holdout split and the TF-IDF corpus."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_HOLDOUT, DEFAULT_PER_CATEGORY, DEFAULT_SEED
from ..session import small


def sample_key(id_col: str, seed: int) -> F.Column:
    """Seeded, engine-independent random order: md5 of 'seed|id'."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def holdout_split(tickets: DataFrame, per_category: int = DEFAULT_PER_CATEGORY,
                  holdout_n: int | None = DEFAULT_HOLDOUT, seed: int = DEFAULT_SEED,
                  category_col: str = "category", id_col: str = "id",
                  rank_first: bool = False, limit: int | None = None) -> DataFrame:
    """D2 + D3: per category take ``per_category`` rows in seeded random
    order; then the first ``holdout_n`` of those in (category, draw) order.

    ``row_number() <= k`` is planned as a WindowGroupLimit, applied on each
    map partition before the shuffle, so even a category holding a third of
    all rows ships at most ``k`` rows per partition. The final ordering runs
    over at most ``per_category`` x categories rows. ``rank_first`` orders
    by (draw, category) instead, so a small ``holdout_n`` still spreads over
    all categories rather than filling the first ones alphabetically."""
    if min(holdout_n or 0, limit or 0) < 0:
        raise ValueError("holdout_n and limit must be >= 0")
    if limit is not None:   # a run's limit only ever shortens the holdout
        holdout_n = limit if holdout_n is None else min(holdout_n, limit)
    w = Window.partitionBy(category_col).orderBy(sample_key(id_col, seed), F.col(id_col))
    sampled = (tickets.withColumn("holdout_rank", F.row_number().over(w))
               .where(F.col("holdout_rank") <= per_category))
    if holdout_n is None:
        return sampled
    order = (["holdout_rank", category_col, id_col] if rank_first
             else [category_col, "holdout_rank", id_col])
    return sampled.orderBy(*order).limit(holdout_n)


def knowledge_base(tickets: DataFrame, holdout: DataFrame, id_col: str = "id",
                   holdout_bound: int | None = None) -> DataFrame:
    """Every ticket whose id is not held out (``left_anti``).

    The holdout side is broadcast only when its row count has a known bound
    (``holdout_n``) that is small; otherwise AQE picks the join from runtime
    sizes."""
    ids = holdout.select(id_col)
    if small(holdout_bound):
        ids = F.broadcast(ids)
    return tickets.join(ids, id_col, "left_anti")


def split(tickets: DataFrame, per_category: int = DEFAULT_PER_CATEGORY,
          holdout_n: int | None = DEFAULT_HOLDOUT, seed: int = DEFAULT_SEED,
          rank_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """Return ``(kb, holdout)``."""
    holdout = holdout_split(tickets, per_category, holdout_n, seed, rank_first=rank_first)
    return knowledge_base(tickets, holdout, holdout_bound=holdout_n), holdout


def corpus(kb: DataFrame, email_col: str = "customer_email",
           reply_col: str = "support_reply", id_col: str = "id") -> DataFrame:
    """The vocabulary corpus, KB emails followed by KB replies.
    Output ``doc_id, side, text``; ``(doc_id, side)`` is unique."""
    return (kb.select(F.col(id_col).alias("doc_id"), F.lit("email").alias("side"),
                      F.col(email_col).alias("text"))
            .unionAll(kb.select(F.col(id_col).alias("doc_id"), F.lit("reply").alias("side"),
                                F.col(reply_col).alias("text"))))
