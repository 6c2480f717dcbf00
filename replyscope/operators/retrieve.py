"""Exact top-k cosine retrieval over sparse TF-IDF vectors.

Cosine of unit vectors is ``sum(wq * wd)`` over shared terms. Every text's
vector is one row; ``pruned.search`` sends copies of a query to the blocks of KB
rows whose bound reaches its threshold, and each block multiplies its sparse
rows with those of its queries in numpy. No row per (query, document) candidate
exists, however common a term is."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch
from .pruned import CLUSTER_ROWS, KB_BLOCK, QUERY_BLOCK, SPARSE, Search, build, search
from .tfidf import gathered


def as_whole(vecs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """One row per key with its vector: ``vecs`` itself if it has whole ones."""
    return vecs if "vec" in vecs.columns else gathered(vecs, keys, [key])


def numbered(queries: DataFrame) -> DataFrame:
    """``row, query_id, self_id, vec`` as a table, so that the row numbers
    stay: rows without an id are told apart by them."""
    own = "self_id" if "self_id" in queries.columns else "query_id"
    return Scratch.of(queries.sparkSession).table(queries.select(
        F.monotonically_increasing_id().alias("row"), "query_id",
        F.col(own).cast("bigint").alias("self_id"), "vec"))


def search_sparse(query_vecs: DataFrame, kb_vecs: DataFrame, queries: DataFrame,
                  kb: DataFrame, k: int, exclude_self: bool = True,
                  query_block: int = QUERY_BLOCK, kb_block: int = KB_BLOCK,
                  cluster_rows: int = CLUSTER_ROWS) -> Search:
    """``topk_sparse`` with its tables of query copies."""
    whole = Scratch.of(kb.sparkSession).table(as_whole(kb_vecs, kb.select("id"), "id")
                                              .select("id", "vec"))
    blocks, clusters = build(whole, SPARSE, kb_block, cluster_rows)
    columns = [c for c in ("query_id", "self_id") if c in queries.columns]
    q = numbered(as_whole(query_vecs, queries.select(*columns), "query_id"))
    return search(q, [blocks], whole, clusters, k, exclude_self, query_block)


def topk_sparse(query_vecs: DataFrame, kb_vecs: DataFrame, queries: DataFrame,
                kb: DataFrame, k: int, exclude_self: bool = True,
                query_block: int = QUERY_BLOCK, kb_block: int = KB_BLOCK,
                cluster_rows: int = CLUSTER_ROWS) -> DataFrame:
    """R2-R4. Inputs: ``query_vecs(query_id, term, w)``,
    ``kb_vecs(id, term, w)``, ``queries(query_id)``, ``kb(id)``; or vectors
    whole, ``query_vecs(query_id, vec)`` with ``self_id`` if the queries have it,
    and ``kb_vecs(id, vec)``, every row of either side among them.
    Output ``query_id, rank, id, score``: for every query the ``min(k, N')``
    best KB rows by (score desc, id asc), where N' excludes the query's own
    id when ``exclude_self``. KB rows without a common term score 0 and fill
    up the ranks in id order. ``queries`` may name the own row in a column
    ``self_id``; otherwise it is ``query_id``. A query without an own id has no
    row to leave out. Ids are unique on either side (``check_unique``): texts
    under one ``query_id``, null included, are one query's."""
    return search_sparse(query_vecs, kb_vecs, queries, kb, k, exclude_self, query_block, kb_block,
                         cluster_rows).top.select("query_id", "rank", "id", "score")


def attach_cases(top: DataFrame, kb: DataFrame) -> DataFrame:
    """Add ``customer_email, support_reply, category`` of each hit.
    Joined after ranking, so only k rows per query carry the long texts."""
    cases = kb.select("id", "customer_email", "support_reply", "category")
    return top.join(cases, "id", "inner").select(
        "query_id", "rank", "id", "score", "customer_email", "support_reply", "category")
