"""The full run: tickets -> split -> retrieve -> reply -> score -> summary."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RunConfig
from ..operators.dense import Encoder
from ..operators.llm import Completer
from ..operators.runner import ModelRunner
from ..operators.split import corpus, holdout_split, knowledge_base
from ..operators.tfidf import counted, vocabulary_from_counts, whole_vectors
from ..operators.summary import component_means, run_meta, summary_table
from ..session import materialize
from .evaluate import evaluate
from .generate import generate


@dataclass
class RunResult:
    kb: DataFrame
    holdout: DataFrame
    vocab: DataFrame | None
    generations: DataFrame
    pairs: DataFrame
    scores: DataFrame
    summary: DataFrame
    components: DataFrame
    meta: DataFrame


def eval_input(holdout: DataFrame, generations: DataFrame) -> DataFrame:
    """The evaluation table: each held-out ticket with its candidate."""
    return (holdout.select("id", "category", "customer_email",
                           F.col("support_reply").alias("reference"))
            .join(generations.select(F.col("query_id").alias("id"),
                                     F.col("reply").alias("generated")), "id", "inner")
            .select("id", "category", "customer_email", "generated", "reference"))


@dataclass
class Answers:
    """The first half of a run: split, vocabulary and replies."""

    kb: DataFrame
    holdout: DataFrame
    vocab: DataFrame | None
    generations: DataFrame


def answer(tickets: DataFrame, cfg: RunConfig = RunConfig(),
           complete: Completer | ModelRunner | None = None, backend: str = "custom",
           encoder: Encoder | ModelRunner | None = None) -> Answers:
    """Split the tickets, fit the vocabulary and reply to the holdout. Tables
    that later stages read several times (the holdout, the KB's counted terms,
    the fitted vocabulary and the generations) are written to the shared
    checkpoint folder as they are produced: each reuse is a scan instead of a
    recomputation, the plans stay small, and a lost executor never sends the run
    back to its sources. They belong to the innermost open ``Scratch``, which
    deletes them."""
    holdout = materialize(holdout_split(tickets, cfg.per_category, cfg.holdout_n, cfg.seed,
                                        rank_first=cfg.holdout_rank_first, limit=cfg.limit))
    # The KB is not copied: it is the source minus a holdout of at most
    # holdout_n rows (a broadcast anti-join, no shuffle), so each of its few
    # uses is one scan of the source, cheaper than writing a full copy.
    kb = knowledge_base(tickets, holdout, holdout_bound=cfg.holdout_n)
    vocab = kb_vecs = None
    if encoder is None:
        # Tokenise the KB corpus once: its counted terms feed both the vocabulary
        # fit and the KB email vectors.
        docs = corpus(kb)
        counts = materialize(counted(docs, ["doc_id", "side"], "text", cfg.stop_words))
        vocab = materialize(vocabulary_from_counts(counts, cfg.max_features, cfg.max_df))
        kb_vecs = whole_vectors(counts.where(F.col("side") == "email")
                                .select(F.col("doc_id").alias("id"), "tc"), vocab, ["id"],
                                cfg.max_features)
    queries = holdout.select(F.col("id").alias("query_id"),
                             F.col("customer_email").alias("query_email"))
    generations, _ = generate(queries, kb, cfg, complete, backend, vocab, kb_vecs, encoder)
    return Answers(kb, holdout, vocab, materialize(generations))


def run(tickets: DataFrame, cfg: RunConfig = RunConfig(),
        complete: Completer | ModelRunner | None = None, backend: str = "custom",
        judge: Completer | ModelRunner | None = None, judge_backend: str | None = None,
        encoder: Encoder | ModelRunner | None = None, embedder: str = "custom") -> RunResult:
    """Run the pipeline: ``answer``, score and sum up.

    ``backend`` names the replying model, ``judge_backend`` the judging one.
    With an ``encoder``, named ``embedder``, its vectors replace TF-IDF in
    retrieval, cosine and token alignment. Ticket ids are unique
    (``check_unique``)."""
    a = answer(tickets, cfg, complete, backend, encoder)
    pairs = eval_input(a.holdout, a.generations)
    scores = materialize(evaluate(pairs, a.vocab, cfg, judge, judge_backend or backend, encoder))
    return RunResult(kb=a.kb, holdout=a.holdout, vocab=a.vocab, generations=a.generations,
                     pairs=pairs, scores=scores, summary=summary_table(scores),
                     components=component_means(scores),
                     meta=run_meta(scores, cfg.weights, "tfidf" if encoder is None else embedder))
