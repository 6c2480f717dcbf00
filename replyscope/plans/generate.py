"""R1, G1 + G2 + G4: index a KB, retrieve cases for a table of queries, build
few-shot prompts and produce a candidate reply per query."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import GENERATION_MAX_TOKENS, GENERATION_TEMPERATURE, RunConfig
from ..functions.prompt import (FAILURE_REPLY, SYSTEM_PROMPT, case_block,
                                grounded_reply, user_prompt)
from ..operators.dense import Encoder, encode_texts, topk_dense
from ..operators.index import KbIndex
from ..operators.llm import Completer, complete_table
from ..operators.pruned import DENSE, SPARSE
from ..operators.retrieve import attach_cases, numbered, topk_sparse
from ..operators.split import corpus
from ..operators.tfidf import counted, fit_vocabulary, whole_vectors
from ..session import materialize

GROUNDED_BACKEND = "grounded"


def keyed(queries: DataFrame) -> DataFrame:
    """``query_id, self_id, query_email`` as a table: ``query_id`` becomes a row
    number and the own id moves to ``self_id``, so that queries without an id
    are told apart."""
    return materialize(queries.select(F.monotonically_increasing_id().alias("query_id"),
                                      F.col("query_id").alias("self_id"), "query_email"))


def ticket_vectors(tickets: DataFrame, cfg: RunConfig, vocab: DataFrame | None,
                   encoder: Encoder | None) -> DataFrame:
    """``id, vec`` of the tickets' emails: an encoder's vectors, or sparse
    TF-IDF ones."""
    if encoder is not None:
        return encode_texts(tickets, "id", "customer_email", encoder)
    return email_vectors(tickets, vocab, ["id"], "customer_email", cfg)


def email_vectors(df: DataFrame, vocab: DataFrame, keys: list[str], text_col: str,
                  cfg: RunConfig) -> DataFrame:
    """``keys..., vec``: sparse TF-IDF vectors, one row per text."""
    return whole_vectors(counted(df, keys, text_col, cfg.stop_words), vocab, keys,
                         cfg.max_features)


def build_index(path: str, kb: DataFrame, cfg: RunConfig = RunConfig(),
                vocab: DataFrame | None = None, encoder: Encoder | None = None,
                **options) -> KbIndex:
    """Index the emails of the tickets ``kb`` under ``path``. The vocabulary
    is fitted on their corpus unless given, and stored with the index."""
    if encoder is not None:
        return KbIndex.create(path, ticket_vectors(kb, cfg, None, encoder), DENSE, **options)
    if vocab is None:
        vocab = fit_vocabulary(corpus(kb), "text", cfg.max_features, cfg.stop_words, cfg.max_df)
    vocab = materialize(vocab)
    return KbIndex.create(path, ticket_vectors(kb, cfg, vocab, None), SPARSE, vocab, **options)


def update_index(index: KbIndex, added: DataFrame | None = None,
                 deleted: DataFrame | None = None, cfg: RunConfig = RunConfig(),
                 encoder: Encoder | None = None) -> KbIndex:
    """The next version of an index: with the tickets ``added``, which replace
    tickets of the same id, without the ids ``deleted(id)``. New emails are
    weighed by the stored vocabulary."""
    vecs = None if added is None else ticket_vectors(added, cfg, index.vocabulary(), encoder)
    return index.apply(vecs, deleted)


def index_topk(queries: DataFrame, index: KbIndex, cfg: RunConfig = RunConfig(),
               encoder: Encoder | None = None) -> DataFrame:
    """R2-R4 against a stored index: ``query_id, rank, id, score``. ``queries``
    as for ``topk_sparse``, with ``query_email``."""
    keys = [c for c in ("query_id", "self_id") if c in queries.columns]
    if index.parts["kind"] == DENSE:
        vecs = encode_texts(queries, "query_id", "query_email", encoder)
        whole = queries.select(*keys).join(vecs, "query_id")
    else:
        whole = email_vectors(queries, index.vocabulary(), keys, "query_email", cfg)
    return index.search(numbered(whole), cfg.top_k, cfg.exclude_self).top \
        .select("query_id", "rank", "id", "score")


def retrieve(queries: DataFrame, kb: DataFrame, cfg: RunConfig = RunConfig(),
             vocab: DataFrame | None = None,
             kb_vecs: DataFrame | None = None,
             encoder: Encoder | None = None,
             index: KbIndex | None = None) -> tuple[DataFrame, DataFrame | None]:
    """R1-R5 end to end: fit the vocabulary on the KB corpus (unless given),
    vectorise KB emails and query emails, rank. ``queries`` needs
    ``query_id, query_email``, and may name the own ticket in ``self_id``;
    ``kb`` the ticket columns. Returns ``(cases, vocab)``; ``cases`` has one row
    per (query, rank). With an ``encoder`` the emails are ranked by its vectors
    and no vocabulary is fitted; with an ``index`` of the KB nothing of it is
    vectorised again. Query ids are unique: ``generate`` numbers its queries,
    so that there they needn't be."""
    if index is not None:
        return attach_cases(index_topk(queries, index, cfg, encoder), kb), index.vocabulary()
    own = "self_id" if "self_id" in queries.columns else "query_id"
    keys = queries.select("query_id", F.col(own).alias("self_id"))
    if encoder is not None:
        top = topk_dense(keys.join(encode_texts(queries, "query_id", "query_email", encoder),
                                   "query_id"),
                         encode_texts(kb, "id", "customer_email", encoder), cfg.top_k,
                         cfg.exclude_self)
        return attach_cases(top, kb), vocab
    if vocab is None:
        vocab = fit_vocabulary(corpus(kb), "text", cfg.max_features, cfg.stop_words, cfg.max_df)
    if kb_vecs is None:
        kb_vecs = email_vectors(kb, vocab, ["id"], "customer_email", cfg)
    q_vecs = email_vectors(queries.withColumn("self_id", F.col(own)), vocab,
                           ["query_id", "self_id"], "query_email", cfg)
    top = topk_sparse(q_vecs, kb_vecs, keys, kb.select("id"), cfg.top_k, cfg.exclude_self)
    return attach_cases(top, kb), vocab


def prompts(queries: DataFrame, cases: DataFrame) -> DataFrame:
    """G1: ``query_id, query_email, user_prompt, top_reply, retrieved``, and
    ``self_id`` if the queries have it.

    Cases are gathered per query (at most k rows each, so the array is
    bounded) and sorted by rank; a query without cases still gets a prompt."""
    per_query = (cases.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct(
        "rank", "id", "score", "customer_email", "support_reply", "category"))).alias("retrieved")))
    own = [c for c in ("self_id",) if c in queries.columns]
    joined = queries.select("query_id", "query_email", *own).join(per_query, "query_id", "left")
    retrieved = F.coalesce("retrieved", F.array().cast(per_query.schema["retrieved"].dataType))
    blocks = F.transform(retrieved, lambda c: case_block(
        c["rank"], c["category"], c["score"], c["customer_email"], c["support_reply"]))
    top = F.filter(retrieved, lambda c: c["rank"] == 1)
    return joined.select(
        "query_id", "query_email", *own,
        user_prompt(blocks, F.col("query_email")).alias("user_prompt"),
        F.try_element_at(top, F.lit(1))["support_reply"].alias("top_reply"),
        retrieved.alias("retrieved"))


def generate(queries: DataFrame, kb: DataFrame, cfg: RunConfig = RunConfig(),
             complete: Completer | None = None, backend: str = "custom",
             vocab: DataFrame | None = None,
             kb_vecs: DataFrame | None = None,
             encoder: Encoder | None = None,
             index: KbIndex | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``query_id, query_email, reply, provider, error, retrieved`` per
    row of ``queries(query_id, query_email)``; rows without an id, or with
    another's, are queries of their own. Without ``complete`` the grounded
    offline reply (G2) is used."""
    queries = keyed(queries)
    cases, vocab = retrieve(queries, kb, cfg, vocab, kb_vecs, encoder, index)
    p = prompts(queries, cases)
    own = F.col("self_id").alias("query_id")
    if complete is None:
        out = p.select(own, "query_email", grounded_reply(F.col("top_reply")).alias("reply"),
                       F.lit(GROUNDED_BACKEND).alias("provider"),
                       F.lit(None).cast("string").alias("error"), "retrieved")
        return out, vocab
    p = materialize(p)          # the answers are joined to it
    done = complete_table(p, "query_id", SYSTEM_PROMPT, "user_prompt", complete, backend,
                          GENERATION_TEMPERATURE, GENERATION_MAX_TOKENS, FAILURE_REPLY)
    out = p.join(done, "query_id", "inner").select(
        own, "query_email", F.col("completion").alias("reply"),
        F.col("backend").alias("provider"), "error", "retrieved")
    return out, vocab
