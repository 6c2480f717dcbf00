"""M1-M12 composed: score a table of (email, candidate, reference) pairs.

Input columns: ``id, category, customer_email, generated, reference``.
Output: one score row per pair (the wide ``scores`` table)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JUDGE_MAX_TOKENS, JUDGE_TEMPERATURE, RunConfig
from ..functions.judge import (JUDGE_SYSTEM, heuristic_dimensions, heuristic_rationale,
                               judge_average, judge_prompt, parse_judge_reply, rubric_scores)
from ..functions.score import final_score, rounded
from ..operators.dense import Encoder, dense_cosine, encode_texts
from ..operators.llm import Completer, complete_table
from ..operators.metrics import (coverage, sparse_cosine, token_alignment,
                                 token_alignment_vectors, token_rows, with_alignment,
                                 with_cosine, with_rouge)
from ..operators.packed import packed
from ..operators.split import corpus
from ..operators.tfidf import fit_vocabulary
from ..session import materialize, spread

BERT_BACKEND = "fallback-wordsim"
VECTOR_BACKEND = "token-vectors"
HEURISTIC = "heuristic"


def pair_vocabulary(pairs: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """Vocabulary fitted on the pairs' own emails and references (used when
    no KB vocabulary is given)."""
    kb_like = pairs.select("id", "customer_email", F.col("reference").alias("support_reply"))
    return fit_vocabulary(corpus(kb_like), "text", cfg.max_features, cfg.stop_words,
                          cfg.max_df)


def with_heuristic(pairs: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """M6 + M10 in the row: ``pairs`` with ``cosine`` gets ``<rubric dims>,
    judge_rationale, judge_backend``."""
    j = pairs.withColumn("cov", coverage("reference", "generated"))
    dims = heuristic_dimensions(F.col("customer_email"), F.col("generated"),
                                F.col("cosine"), F.col("cov"))
    return j.select(*pairs.columns, *rubric_scores(dims, cfg.rubric),
                    heuristic_rationale(F.col("customer_email"), F.col("generated"),
                                        F.col("cosine"), F.col("cov")).alias("judge_rationale"),
                    F.lit(HEURISTIC).alias("judge_backend"))


def heuristic_judge(pairs: DataFrame, cosine: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """M6 + M10 per pair: ``pair_id, <rubric dims>, judge_rationale,
    judge_backend``."""
    j = with_heuristic(pairs.join(cosine, "pair_id", "inner"), cfg)
    return j.select("pair_id", *cfg.rubric, "judge_rationale", "judge_backend")


def llm_judge(pairs: DataFrame, heuristic: DataFrame, complete: Completer, backend: str,
              cfg: RunConfig = RunConfig()) -> DataFrame:
    """M7-M9: ask a model per pair and parse its reply; rows whose call
    fails or whose JSON is malformed take the heuristic row, and record
    ``heuristic`` as their backend. ``heuristic`` has a row per pair; its other
    columns come along."""
    ask = pairs.select("pair_id", judge_prompt("customer_email", "generated", "reference",
                                               cfg.rubric).alias("judge_prompt"))
    done = complete_table(ask, "pair_id", JUDGE_SYSTEM, "judge_prompt", complete, backend,
                          JUDGE_TEMPERATURE, JUDGE_MAX_TOKENS, None, HEURISTIC)
    parsed = parse_judge_reply(F.col("completion"), cfg.rubric)
    done = done.select("pair_id", "completion", "error",
                       (F.col("error").isNull() & parsed["ok"]).alias("use_llm"),
                       *[parsed[d].alias(f"llm_{d}") for d in cfg.rubric],
                       parsed["rationale"].alias("llm_rationale"))
    j = heuristic.join(done, "pair_id", "inner")
    pick = lambda a, b: F.when(F.col("use_llm"), F.col(a)).otherwise(F.col(b))
    judged = {*cfg.rubric, "judge_rationale", "judge_backend"}
    return j.select(*[c for c in heuristic.columns if c not in judged],
                    *[pick(f"llm_{d}", d).alias(d) for d in cfg.rubric],
                    pick("llm_rationale", "judge_rationale").alias("judge_rationale"),
                    F.when(F.col("use_llm"), F.lit(backend)).otherwise(F.lit(HEURISTIC))
                    .alias("judge_backend"))


def encoded_cosine(pairs: DataFrame, encoder: Encoder) -> DataFrame:
    """M1 with an encoder: ``pair_id, cosine``."""
    def side(column: str, name: str) -> DataFrame:
        return encode_texts(pairs, "pair_id", column, encoder).withColumnRenamed("vec", name)

    return (side("generated", "g").join(side("reference", "r"), "pair_id")
            .select("pair_id", dense_cosine("g", "r").alias("cosine")))


def encoded_alignment(pairs: DataFrame, encoder: Encoder) -> DataFrame:
    """M3 with an encoder that embeds each distinct word once."""
    words = materialize(token_rows(pairs))
    vectors = encode_texts(words.select("word").distinct(), "word", "word", encoder)
    return token_alignment_vectors(words.join(vectors, "word"))


def evaluate(pairs: DataFrame, vocab: DataFrame | None = None, cfg: RunConfig = RunConfig(),
             judge: Completer | None = None, judge_backend: str = "custom",
             encoder: Encoder | None = None) -> DataFrame:
    """Score rows: ``id, category, cosine, bertscore_precision,
    bertscore_recall, bertscore_f1, bertscore_backend, judge_avg_1to5,
    judge_normalized, judge_backend, final_score, rouge_l_f1,
    judge_rationale, judge_dimensions`` plus one column per rubric dim. With
    an ``encoder`` (V6) cosine and token alignment use its vectors instead of
    TF-IDF. Pairs without an id, or with another's, are pairs of their own."""
    # Numbered once, as a table, so that the numbers stay; a table of few small
    # files is dealt over the cores again.
    p = spread(materialize(pairs.select(F.monotonically_increasing_id().alias("pair_id"), "id", "category", "customer_email",
                                 F.coalesce("generated", F.lit("")).alias("generated"),
                                 F.coalesce("reference", F.lit("")).alias("reference"))))
    names = {"precision": "bert_precision", "recall": "bert_recall", "f1": "bert_f1"}
    if encoder is not None:
        bert = encoded_alignment(p, encoder).withColumnsRenamed(names)
        scored = p.join(encoded_cosine(p, encoder), "pair_id").join(bert, "pair_id")
    else:
        if vocab is None:
            vocab = materialize(pair_vocabulary(
                p.select("customer_email", "reference", F.col("pair_id").alias("id")), cfg))
        shared = packed(vocab, cfg.max_features)
        if shared is not None:      # everything in the pair's own row
            scored = with_alignment(with_cosine(p, shared, stop_words=cfg.stop_words), shared,
                                    stop_words=cfg.stop_words).withColumnsRenamed(names)
        else:
            cos = sparse_cosine(p, vocab, stop_words=cfg.stop_words, vocab_bound=cfg.max_features)
            bert = token_alignment(p, vocab, stop_words=cfg.stop_words,
                                   vocab_bound=cfg.max_features).withColumnsRenamed(names)
            scored = p.join(cos, "pair_id").join(bert, "pair_id")
    j = with_heuristic(with_rouge(scored, prefix="rouge_"), cfg)
    if judge is not None:
        j = materialize(j)          # the answers are joined to it
        j = llm_judge(p, j, judge, judge_backend, cfg)
    avg, norm = judge_average(cfg.rubric)
    dims_map = F.map_from_arrays(F.array(*[F.lit(d) for d in cfg.rubric]),
                                 F.array(*[F.col(d) for d in cfg.rubric]))
    return j.select(
        rounded("cosine", F.col("cosine")),
        rounded("bertscore_precision", F.col("bert_precision")),
        rounded("bertscore_recall", F.col("bert_recall")),
        rounded("bertscore_f1", F.col("bert_f1")),
        F.lit(BERT_BACKEND if encoder is None else VECTOR_BACKEND).alias("bertscore_backend"),
        rounded("judge_avg_1to5", avg),
        rounded("judge_normalized", norm),
        "judge_backend",
        final_score(norm, F.col("bert_f1"), F.col("cosine"), cfg.weights).alias("final_score"),
        "id", "category",
        rounded("rouge_l_f1", F.col("rouge_f1")),
        "judge_rationale",
        dims_map.alias("judge_dimensions"),
        *[F.col(d) for d in cfg.rubric])
