"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each reading the given tables (so its work grows with them).

Fixed parameters are the defaults of the evaluated system (seed 42, k = 3,
4096 features, 2 held out per category, 20 held out in total)."""
from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..functions.judge import judge_prompt, parse_judge_reply
from ..functions.score import round_to
from ..functions.text import with_tfidf_terms, word_tokens
from ..operators.dense import dense_cosine, encode_texts, topk_dense
from ..operators.llm import complete_table, echo_completer
from ..operators.metrics import coverage, rouge_l, sparse_cosine, token_alignment, \
    token_alignment_vectors, token_rows
from ..operators.quantile import exact_medians
from ..operators.retrieve import topk_sparse
from ..operators.split import corpus, holdout_split, knowledge_base
from ..operators.summary import (component_means, describe_by_category, describe_overall,
                                 distinct_categories, retrieval_hit_rate, run_meta,
                                 summary_table)
from ..operators.tfidf import (counted, fit_vocabulary, l2_normalize, vectors_from_counts,
                               vocabulary_from_counts, whole_vectors)
from ..sources.reports import (generated_rows, per_email, read_tickets_csv, report_path,
                               scores_wide, summary_lines, write_report, write_tickets_csv)
from ..sources.tables import eval_pairs, pairs, read_table
from ..sources.tickets import tickets_from_table
from .evaluate import heuristic_judge, pair_vocabulary
from .pipeline import answer, run
from ..session import Scratch, materialize, spread

CFG = RunConfig()
K = CFG.top_k
DIGITS = 6          # output rounding of free-form doubles


def _r(c, d: int = DIGITS):
    return round_to(c, d)


# ---------------------------------------------------------------- sources
def q_pairs_from_conversations(spark: SparkSession, sf: str) -> DataFrame:
    return pairs(spark, sf).select("id", "category", "customer_email", "support_reply")


def q_eval_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return eval_pairs(spark, sf)


def tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets (D1), one per ``documents`` row, keyed by ``doc_id``."""
    return tickets_from_table(read_table(spark, sf, "documents"), "doc_id", CFG.seed)


def given(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets given as texts: the pairs of ``conversations``."""
    return pairs(spark, sf).select("id", "customer_email", "support_reply", "category")


def q_ticket_generate(spark, sf):
    return tickets(spark, sf).select("id", "category", "customer_email", "support_reply")


def q_holdout_split(spark, sf):
    return holdout_split(given(spark, sf), CFG.per_category, CFG.holdout_n, CFG.seed) \
        .select("id", "category", F.col("holdout_rank").cast("bigint").alias("holdout_rank"))


LIMIT = 7


def q_holdout_limit(spark, sf):
    """D3: a run's limit shortens the holdout."""
    cfg = RunConfig(limit=LIMIT)
    return holdout_split(given(spark, sf), cfg.per_category, cfg.holdout_n, cfg.seed,
                         limit=cfg.limit).select(
        "id", "category", F.col("holdout_rank").cast("bigint").alias("holdout_rank"))


def q_kb_anti(spark, sf):
    t = given(spark, sf)
    h = holdout_split(t, CFG.per_category, CFG.holdout_n, CFG.seed)
    return knowledge_base(t, h, holdout_bound=CFG.holdout_n).select("id", "category")


def q_corpus_union(spark, sf):
    t = given(spark, sf)
    kb = knowledge_base(t, holdout_split(t, CFG.per_category, CFG.holdout_n, CFG.seed),
                        holdout_bound=CFG.holdout_n)
    return corpus(kb)


def q_distinct_categories(spark, sf):
    return distinct_categories(given(spark, sf))


# ---------------------------------------------------------------- text
def q_tokenize_words(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", word_tokens("text").alias("w"))
    return d.select("doc_id", F.size("w").cast("bigint").alias("n_words"),
                    F.array_join("w", " ").alias("words"))


def q_tfidf_terms(spark, sf):
    d = with_tfidf_terms(read_table(spark, sf, "documents").select("doc_id", "text"),
                         "text", "t")
    return d.select("doc_id", F.size("t").cast("bigint").alias("n_terms"),
                    F.array_join("t", "|").alias("terms"))


def _vocab_out(v: DataFrame) -> DataFrame:
    return v.select("term", "tf", "df", _r(F.col("idf")).alias("idf"))


def pairs_corpus(spark, sf) -> DataFrame:
    return corpus(pairs(spark, sf))


def q_tfidf_vocab(spark, sf):
    return _vocab_out(fit_vocabulary(pairs_corpus(spark, sf), "text", CFG.max_features))


def documents_vocab(spark, sf) -> DataFrame:
    return fit_vocabulary(read_table(spark, sf, "documents").select("text"), "text",
                          CFG.max_features)


def q_tfidf_vocab_documents(spark, sf):
    return _vocab_out(documents_vocab(spark, sf))


def q_tfidf_vectors(spark, sf):
    """Fit + transform over all documents, tokenising each text once: the
    counted terms are a table that feeds both the vocabulary and the vectors."""
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    counts = materialize(counted(docs, ["doc_id"], "text"))
    vocab = materialize(vocabulary_from_counts(counts, CFG.max_features))
    v = vectors_from_counts(counts, vocab, ["doc_id"])
    return v.select("doc_id", "term", _r(F.col("w")).alias("w"))


def q_l2_normalize_dense(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", l2_normalize("embedding").alias("v"))
    return e.select("vec_id", F.posexplode("v").alias("pos", "x")) \
        .select("vec_id", F.col("pos").cast("bigint").alias("pos"), _r(F.col("x")).alias("x"))


# ---------------------------------------------------------------- retrieval
def _pair_retrieval(spark, sf, queries: DataFrame, exclude_self: bool) -> DataFrame:
    p = pairs(spark, sf)
    vocab = materialize(fit_vocabulary(corpus(p), "text", CFG.max_features))
    kb_vecs = whole_vectors(counted(p, ["id"], "customer_email"), vocab, ["id"])
    q_vecs = whole_vectors(counted(queries, ["query_id"], "query_email"), vocab, ["query_id"])
    top = topk_sparse(q_vecs, kb_vecs, queries.select("query_id"), p.select("id"), K,
                      exclude_self)
    return top.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id",
                      _r(F.col("score")).alias("score"))


def _pair_queries(spark, sf) -> DataFrame:
    return pairs(spark, sf).select(F.col("id").alias("query_id"),
                                   F.col("customer_email").alias("query_email"))


def q_topk_sparse(spark, sf):
    return _pair_retrieval(spark, sf, _pair_queries(spark, sf), exclude_self=False)


def q_topk_self_excluded(spark, sf):
    return _pair_retrieval(spark, sf, _pair_queries(spark, sf), exclude_self=True)


def q_topk_zero_pad(spark, sf):
    b = read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"),
                                                  F.col("text").alias("query_email"))
    return _pair_retrieval(spark, sf, b, exclude_self=False)


def q_topk_dense(spark, sf):
    e = read_table(spark, sf, "embeddings")
    q = e.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vec"))
    kb = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    top = topk_dense(q, kb, K, exclude_self=True)
    return top.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id",
                      _r(F.col("score")).alias("score"))


def q_topk_indexed(spark, sf):
    """A stored index of the pairs: the tickets of category c0 arrive later and
    those of c1 are deleted, as a delta; every pair against what is left."""
    from .generate import build_index, index_topk, update_index
    p = given(spark, sf)
    vocab = fit_vocabulary(corpus(p), "text", CFG.max_features)
    index = build_index(_file(spark), p.where("category <> 'c0'"), CFG, vocab)
    index = update_index(index, p.where("category = 'c0'"),
                         p.where("category = 'c1'").select("id"), CFG)
    top = index_topk(_pair_queries(spark, sf), index, CFG)
    return top.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id",
                      _r(F.col("score")).alias("score"))


def q_cases_without_ids(spark, sf):
    """The cases of queries that have no id, each text for itself."""
    from .generate import generate
    p = given(spark, sf)
    vocab = materialize(fit_vocabulary(corpus(p), "text", CFG.max_features))
    q = read_table(spark, sf, "benchmark").select(F.lit(None).cast("bigint").alias("query_id"),
                                                  F.col("text").alias("query_email"))
    out, _ = generate(q, p, CFG, vocab=vocab)
    return out.select("query_email", F.inline("retrieved")).select(
        "query_email", F.col("rank").cast("bigint").alias("rank"), "id",
        _r(F.col("score")).alias("score"))


# ---------------------------------------------------------------- ticket run
def ticket_run(spark, sf):
    return run(given(spark, sf), CFG)


def ticket_answers(spark, sf):
    """The half of the run before scoring."""
    return answer(given(spark, sf), CFG)


def q_retrieved_cases(spark, sf):
    g = ticket_answers(spark, sf).generations
    return g.select("query_id", F.inline("retrieved")).select(
        "query_id", F.col("rank").cast("bigint").alias("rank"), "id",
        _r(F.col("score")).alias("score"), "category")


def q_fewshot_prompt(spark, sf):
    from .generate import prompts
    g = ticket_answers(spark, sf).generations
    return prompts(g, g.select("query_id", F.inline("retrieved"))).select("query_id", "user_prompt")


def q_retrieval_hit_rate(spark, sf):
    r = ticket_answers(spark, sf)
    cases = r.generations.select("query_id", F.inline("retrieved")).select("query_id", "rank",
                                                                          "category")
    q = r.holdout.select(F.col("id").alias("query_id"), "category")
    return retrieval_hit_rate(cases, q).select(
        "category", "n_queries", "n_cases", _r(F.col("top1_hit_rate")).alias("top1_hit_rate"),
        _r(F.col("case_hit_rate")).alias("case_hit_rate"))


def q_grounded_reply(spark, sf):
    return ticket_answers(spark, sf).generations.select("query_id", "reply")


def pair_scores(spark, sf):
    """Score rows of every evaluation pair, as a table."""
    from .evaluate import evaluate
    return materialize(evaluate(eval_pairs(spark, sf), None, CFG))


SCORE_COLS = ("id", "category", "cosine", "bertscore_precision", "bertscore_recall",
              "bertscore_f1", "judge_avg_1to5", "judge_normalized", "final_score",
              *CFG.rubric)


def q_score_rows(spark, sf):
    return ticket_run(spark, sf).scores.select(*SCORE_COLS)


def q_final_score(spark, sf):
    return ticket_run(spark, sf).scores.select("id", "final_score")


def q_describe_overall(spark, sf):
    return describe_overall(pair_scores(spark, sf))


def q_describe_by_category(spark, sf):
    return describe_by_category(pair_scores(spark, sf))


def q_summary_table(spark, sf):
    return summary_table(pair_scores(spark, sf))


def q_component_means(spark, sf):
    return component_means(pair_scores(spark, sf))


def q_run_meta(spark, sf):
    return run_meta(pair_scores(spark, sf), CFG.weights)


def q_generated_report(spark, sf):
    r = ticket_answers(spark, sf)
    return generated_rows(r.generations, r.holdout)


def q_scores_wide(spark, sf):
    return scores_wide(pair_scores(spark, sf), CFG.rubric)


def q_summary_text(spark, sf):
    s = pair_scores(spark, sf)
    return summary_lines(summary_table(s), component_means(s), run_meta(s, CFG.weights))


# ---------------------------------------------------------------- pair metrics
def _eval(spark, sf) -> DataFrame:
    return eval_pairs(spark, sf).select(F.col("id").alias("pair_id"), "category",
                                        "customer_email", "generated", "reference")


def _eval_table(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The evaluation pairs as a table, dealt over the cores, and the vocabulary
    fitted on them."""
    p = spread(materialize(_eval(spark, sf)))
    return p, materialize(pair_vocabulary(p.withColumnRenamed("pair_id", "id"), CFG))


def q_cosine_pairs(spark, sf):
    return sparse_cosine(*_eval_table(spark, sf)) \
        .select(F.col("pair_id").alias("id"), _r(F.col("cosine")).alias("cosine"))


def q_cosine_dense_pairs(spark, sf):
    e = read_table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("vec_id").alias("next_id"),
                   F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id", "inner").select(
        "vec_id", "next_id", _r(dense_cosine("embedding", "other")).alias("cosine"))


def q_token_alignment_prf(spark, sf):
    t = token_alignment(*_eval_table(spark, sf))
    return t.select(F.col("pair_id").alias("id"), _r(F.col("precision")).alias("precision"),
                    _r(F.col("recall")).alias("recall"), _r(F.col("f1")).alias("f1"))


def digest_encoder(texts: list[str]):
    """A deterministic stand-in encoder: the first eight 16-bit numbers of a
    text's md5, centred."""
    import hashlib

    import numpy as np
    raw = b"".join(hashlib.md5(t.encode()).digest() for t in texts)
    return np.frombuffer(raw, dtype=">u2").reshape(-1, 8).astype(float) - 32767.5


def q_encode_texts(spark, sf):
    v = encode_texts(read_table(spark, sf, "documents"), "doc_id", "text", digest_encoder)
    return v.select("doc_id", F.posexplode("vec").alias("pos", "x")) \
        .select("doc_id", F.col("pos").cast("bigint").alias("pos"), _r(F.col("x")).alias("x"))


def token_vectors(spark, sf) -> DataFrame:
    """The words of every evaluation pair with a vector per distinct word."""
    words = materialize(token_rows(_eval(spark, sf)))
    return words.join(encode_texts(words.select("word").distinct(), "word", "word",
                                   digest_encoder), "word")


def q_evaluate_encoded(spark, sf):
    from .evaluate import evaluate
    s = evaluate(eval_pairs(spark, sf), None, CFG, encoder=digest_encoder)
    return s.select("id", "cosine", "bertscore_precision", "bertscore_recall", "bertscore_f1",
                    "bertscore_backend")


def q_topk_encoded(spark, sf):
    from .generate import retrieve
    p = given(spark, sf)
    cases, _ = retrieve(_pair_queries(spark, sf), p, CFG, encoder=digest_encoder)
    return cases.select("query_id", F.col("rank").cast("bigint").alias("rank"), "id",
                        _r(F.col("score")).alias("score"))


def length_judge(system: str, user: str, temperature: float, max_tokens: int) -> str:
    """A deterministic stand-in judge: scores from the length of its prompt,
    now and then no verdict, a broken one or none at all."""
    n = len(user)
    if n % 5 == 0:
        raise RuntimeError("model unavailable")
    if n % 5 == 1:
        return "no verdict"
    if n % 5 == 2:
        return '{"correctness": }'
    return f'Verdict: {{"correctness": {n % 9}, "tone": "{n % 4}.5", "rationale": "n={n}"}}'


def q_llm_judge(spark, sf):
    from .evaluate import evaluate
    s = evaluate(eval_pairs(spark, sf), None, CFG, length_judge, "length")
    return s.select("id", *CFG.rubric, "judge_rationale", "judge_backend")


def q_token_alignment_vectors(spark, sf):
    t = token_alignment_vectors(token_vectors(spark, sf))
    return t.select("pair_id", _r(F.col("precision")).alias("precision"),
                    _r(F.col("recall")).alias("recall"), _r(F.col("f1")).alias("f1"))


def q_rouge_l(spark, sf):
    r = rouge_l(spread(materialize(_eval(spark, sf))))
    return r.select(F.col("pair_id").alias("id"), "lcs", _r(F.col("precision")).alias("precision"),
                    _r(F.col("recall")).alias("recall"), _r(F.col("f1")).alias("f1"))


def q_metric_medians(spark, sf):
    """The exact median of the unrounded cosine and ROUGE-L per category."""
    p, vocab = _eval_table(spark, sf)
    m = materialize(p.select("pair_id", "category").join(sparse_cosine(p, vocab), "pair_id")
                    .join(rouge_l(p).select("pair_id", "f1"), "pair_id"))
    cos = exact_medians(m, "cosine", ["category"]).withColumnRenamed("median", "c")
    f1 = exact_medians(m, "f1", ["category"]).withColumnRenamed("median", "r").drop("n")
    return cos.join(f1, "category").select(
        "category", "n", _r(F.col("c")).alias("median_cosine"), _r(F.col("r")).alias("median_rouge_l"))


def q_coverage(spark, sf):
    p = _eval(spark, sf)
    return p.select(F.col("pair_id").alias("id"),
                    _r(coverage("reference", "generated")).alias("coverage"))


def q_heuristic_judge(spark, sf):
    p, vocab = _eval_table(spark, sf)
    j = heuristic_judge(p, sparse_cosine(p, vocab), CFG)
    return j.select(F.col("pair_id").alias("id"), *CFG.rubric, "judge_rationale")


def q_judge_prompt(spark, sf):
    p = _eval(spark, sf)
    return p.select(F.col("pair_id").alias("id"),
                    judge_prompt("customer_email", "generated", "reference").alias("judge_prompt"))


# Replies that are no flat object of plain numbers, with what they give: whether
# they parse, the score of correctness, and the rationale.
ODD_REPLIES = (
    ('{"correctness": 4, "correctness": 2}', True, 2, ""),
    ('{"correctness": NaN, "rationale": "nan"}', True, 3, "nan"),
    ('{"correctness": "4_0", "rationale": true}', True, 5, "True"),
    ('{"correctness": 1e0, "rationale": 2.50}', True, 1, "2.5"),
    ('{"correctness": [5], "rationale": ["a", null, {"b": 1}]}', True, 3,
     "['a', None, {'b': 1}]"),
    ('{"correctness": Infinity}', False, 3, ""),
    ('{"correctness": true, "rationale": null}', True, 1, "None"),
    ('{"correctness": " 4 ", "rationale": "\\u00e9\\n"}', True, 4, "\u00e9\n"),
    ("{'correctness': 4}", False, 3, ""),
    ('{"a": 1} and {"correctness": 4}', False, 3, ""),
    ('{"correctness": -7.5, "extra": {"correctness": 5}}', True, 1, ""),
    ('{"correctness": "four"}', True, 3, ""),
    ('{}', True, 3, ""),
)
ODD_EVERY = 17


def judge_replies(spark, sf) -> DataFrame:
    """Judge replies derived from ``labels``: well-formed JSON for most rows,
    no braces for every 7th doc, broken JSON for every 11th, and one of
    ``ODD_REPLIES`` for the doc ids that leave its number modulo ``ODD_EVERY``."""
    lab = read_table(spark, sf, "labels")
    good = F.concat(F.lit('Verdict {"correctness": '), (F.col("quality") * 4 + 1).cast("string"),
                    F.lit(', "tone": "'), (F.lit(5) - F.col("toxic") * 3).cast("string"),
                    F.lit('", "empathy": null, "grammar": 2.5, "actionability": 7, '
                          '"rationale": "doc '), F.col("doc_id").cast("string"),
                    F.lit('"} end'))
    reply = F.when(F.lit(False), "")
    for i, (text, *_) in enumerate(ODD_REPLIES):
        reply = reply.when(F.col("doc_id") % ODD_EVERY == i, F.lit(text))
    reply = (reply.when(F.col("doc_id") % 7 == 0, F.lit("no verdict given"))
             .when(F.col("doc_id") % 11 == 0, F.lit('{"correctness": 4, "tone": }'))
             .otherwise(good))
    return lab.select("doc_id", reply.alias("reply"))


def q_judge_parse(spark, sf):
    r = judge_replies(spark, sf)
    parsed = parse_judge_reply(F.col("reply"), CFG.rubric)
    return r.select("doc_id", parsed["ok"].alias("ok"),
                    *[parsed[d].alias(d) for d in CFG.rubric],
                    parsed["rationale"].alias("rationale"))


def q_llm_complete_stub(spark, sf):
    p = _eval(spark, sf).select("pair_id", judge_prompt("customer_email", "generated",
                                                        "reference").alias("prompt"))
    return complete_table(p, "pair_id", "system", "prompt", echo_completer, "echo", 0.0, 300,
                          None)


def q_evaluate_pairs(spark, sf):
    from .evaluate import evaluate
    s = evaluate(eval_pairs(spark, sf), None, CFG)
    return s.select(*SCORE_COLS)


def _file(spark) -> str:
    """A path of its own for a file that a query writes and reads again; it
    goes with the program's other tables."""
    return os.path.join(Scratch(spark).claim(), "out")


def odd_tickets(spark, sf) -> DataFrame:
    """Given tickets with outer spaces, line breaks, quotes, empty and null
    replies."""
    n = F.col("id") % 6
    reply = F.col("support_reply")
    return given(spark, sf).withColumn("support_reply", F.when(n == 0, F.concat(
        F.lit("  "), reply, F.lit("\t "))).when(n == 1, F.concat(F.lit('a "b", c\n'), reply))
        .when(n == 2, F.lit("")).when(n == 3, F.lit(None)).otherwise(reply))


def q_tickets_csv(spark, sf):
    path = _file(spark)
    write_tickets_csv(odd_tickets(spark, sf), path)
    return read_tickets_csv(spark, path)


def q_per_email_json(spark, sf):
    path = _file(spark)
    rows = per_email(pair_scores(spark, sf), CFG.rubric)
    rows.write.json(path)
    back = spark.read.schema(rows.schema).json(path)
    return back.select("id", "final_score", F.concat_ws(
        ",", *[F.col("judge_dimensions")[d].cast("string") for d in CFG.rubric]).alias("dimensions"))


def q_report_files(spark, sf):
    """All report files written; the lines of the summary text read again."""
    path = _file(spark)
    write_report(ticket_run(spark, sf), path, CFG.rubric)
    lines = spark.read.text(report_path(spark, path, "summary_txt")).select(F.col("value").alias("line"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "pairs_from_conversations": q_pairs_from_conversations,
    "eval_pairs": q_eval_pairs,
    "ticket_generate": q_ticket_generate,
    "holdout_split": q_holdout_split,
    "kb_anti": q_kb_anti,
    "corpus_union": q_corpus_union,
    "distinct_categories": q_distinct_categories,
    "tokenize_words": q_tokenize_words,
    "tfidf_terms": q_tfidf_terms,
    "tfidf_vocab": q_tfidf_vocab,
    "tfidf_vocab_documents": q_tfidf_vocab_documents,
    "tfidf_vectors": q_tfidf_vectors,
    "l2_normalize_dense": q_l2_normalize_dense,
    "topk_sparse": q_topk_sparse,
    "topk_self_excluded": q_topk_self_excluded,
    "topk_zero_pad": q_topk_zero_pad,
    "topk_dense": q_topk_dense,
    "topk_indexed": q_topk_indexed,
    "cases_without_ids": q_cases_without_ids,
    "holdout_limit": q_holdout_limit,
    "retrieved_cases": q_retrieved_cases,
    "fewshot_prompt": q_fewshot_prompt,
    "grounded_reply": q_grounded_reply,
    "retrieval_hit_rate": q_retrieval_hit_rate,
    "cosine_pairs": q_cosine_pairs,
    "cosine_dense_pairs": q_cosine_dense_pairs,
    "token_alignment_prf": q_token_alignment_prf,
    "token_alignment_vectors": q_token_alignment_vectors,
    "rouge_l": q_rouge_l,
    "metric_medians": q_metric_medians,
    "coverage": q_coverage,
    "heuristic_judge": q_heuristic_judge,
    "judge_prompt": q_judge_prompt,
    "judge_parse": q_judge_parse,
    "llm_complete_stub": q_llm_complete_stub,
    "score_rows": q_score_rows,
    "final_score": q_final_score,
    "describe_overall": q_describe_overall,
    "describe_by_category": q_describe_by_category,
    "summary_table": q_summary_table,
    "component_means": q_component_means,
    "run_meta": q_run_meta,
    "generated_report": q_generated_report,
    "scores_wide": q_scores_wide,
    "summary_text": q_summary_text,
    "evaluate_pairs": q_evaluate_pairs,
    "encode_texts": q_encode_texts,
    "topk_encoded": q_topk_encoded,
    "evaluate_encoded": q_evaluate_encoded,
    "llm_judge": q_llm_judge,
    "tickets_csv": q_tickets_csv,
    "per_email_json": q_per_email_json,
    "report_files": q_report_files,
}
