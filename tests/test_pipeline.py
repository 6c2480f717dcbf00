import os
import tempfile
from dataclasses import replace

import pytest

from pyspark.sql import functions as F

from replyscope.config import RunConfig
from replyscope.operators.llm import echo_completer
from replyscope.plans.evaluate import evaluate
from replyscope.plans.pipeline import run
from replyscope.sources.reports import (read_or_generate, read_tickets_csv, report_path,
                                        write_report, write_tickets_csv)
from replyscope.sources.tables import eval_pairs, read_table
from replyscope.sources.tickets import generate_tickets, tickets_from_table


def failing_completer():
    """A model that never answers; made here so that workers get it by value."""
    def fail(system, user, temperature, max_tokens):
        raise RuntimeError("model unavailable")
    return fail


def test_tickets_deterministic(spark):
    a = generate_tickets(spark.range(40)).orderBy("id").collect()
    b = generate_tickets(spark.range(40)).orderBy("id").collect()
    assert a == b
    assert {r.category for r in a} == {r.category for r in a[:10]}
    assert all("{" not in r.customer_email and "{" not in r.support_reply for r in a)


def test_run_invariants(spark, sf):
    t = tickets_from_table(read_table(spark, sf, "documents"), "doc_id")
    r = run(t)
    ho = {x.id for x in r.holdout.collect()}
    kb = {x.id for x in r.kb.collect()}
    assert len(ho) == 20 and not (ho & kb) and len(ho) + len(kb) == t.count()
    per_query = r.generations.select(F.size("retrieved").alias("n")).collect()
    assert all(x.n == 3 for x in per_query)
    s = r.scores.collect()
    assert len(s) == 20
    assert all(0 <= x.final_score <= 100 and 0 <= x.cosine <= 1 for x in s)
    summary = {x.category: x["count"] for x in r.summary.collect()}
    assert summary[None] == 20


def test_llm_callables_fall_back_per_row(spark, sf):
    t = tickets_from_table(read_table(spark, sf, "documents"), "doc_id")
    r = run(t, complete=failing_completer(), backend="broken")
    g = r.generations.collect()
    assert all(x.provider == "fallback" and x.error for x in g)
    # The echo model repeats the prompt's last line, whose braces hold no valid
    # JSON: every row falls back to the heuristic judge.
    r2 = run(t, complete=echo_completer, backend="echo", judge=echo_completer)
    assert {x.judge_backend for x in r2.scores.collect()} == {"heuristic"}
    judge = lambda system, user, temperature, max_tokens: '{"correctness": 4, "tone": 2}'
    r3 = run(t, judge=judge, backend="json-model")
    s = r3.scores.collect()
    assert all(x.judge_backend == "json-model" and x.correctness == 4 and x.tone == 2
               and x.empathy == 3 for x in s)


def test_same_result_for_1_and_8_partitions(spark, sf):
    pairs = eval_pairs(spark, sf)
    cols = ["id", "cosine", "bertscore_f1", "final_score"]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    one = sorted(evaluate(pairs).select(*cols).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    eight = sorted(evaluate(pairs).select(*cols).collect())
    assert one == eight


def test_alignment_swaps_with_sides(spark, sf):
    from replyscope.operators.metrics import token_alignment
    from replyscope.plans.evaluate import pair_vocabulary
    p = eval_pairs(spark, sf)
    v = pair_vocabulary(p)
    a = p.select(F.col("id").alias("pair_id"), "generated", "reference")
    b = p.select(F.col("id").alias("pair_id"), F.col("reference").alias("generated"),
                 F.col("generated").alias("reference"))
    x = {r.pair_id: (r.precision, r.recall) for r in token_alignment(a, v).collect()}
    y = {r.pair_id: (r.recall, r.precision) for r in token_alignment(b, v).collect()}
    assert x.keys() == y.keys()
    assert all(abs(x[k][0] - y[k][0]) < 1e-9 and abs(x[k][1] - y[k][1]) < 1e-9 for k in x)


def test_report_round_trip(spark, sf):
    t = tickets_from_table(read_table(spark, sf, "documents"), "doc_id")
    out = tempfile.mkdtemp(prefix="replyscope-report-", dir="/tmp")
    write_tickets_csv(t, os.path.join(out, "tickets"))
    back = read_tickets_csv(spark, os.path.join(out, "tickets"))
    assert back.count() == t.count()
    assert sorted(back.collect()) == sorted(t.select("id", "customer_email", "support_reply", "category").collect())
    r = run(back)
    report = os.path.join(out, "report")
    write_report(r, report)
    lines = spark.read.text(report_path(spark, report, "summary_txt")).collect()
    assert lines[0].value == "=" * 66 and any("Emails evaluated : 20" in x.value for x in lines)
    gen = spark.read.option("header", True).csv(report_path(spark, report, "generated")).collect()
    assert len(gen) == 20 and all(len(x.retrieved_ids.split("|")) == 3 for x in gen)

    # A run that ends between two outputs leaves the report as it was.
    shown = report_path(spark, report, "scores")
    broken = replace(r, summary=r.summary.withColumn("mean", F.raise_error(F.lit("ended here"))))
    with pytest.raises(Exception, match="ended here"):
        write_report(broken, report)
    assert report_path(spark, report, "scores") == shown
    assert spark.read.option("header", True).csv(shown).count() == 20
    # Started again it is shown, and of older reports one is kept.
    again = [write_report(r, report) for _ in range(2)]
    assert report_path(spark, report, "scores") == os.path.join(again[1], "scores")
    assert len(os.listdir(os.path.join(report, "reports"))) == 2 and not os.path.exists(shown)
    assert spark.read.text(report_path(spark, report, "summary_txt")).collect() == lines
    with pytest.raises(FileNotFoundError):
        report_path(spark, os.path.join(out, "none"), "scores")


def test_tickets_are_read_or_generated(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="replyscope-tickets-", dir="/tmp"), "csv")
    first = read_or_generate(spark, path, 30).collect()
    assert sorted(first) == sorted(generate_tickets(spark.range(30)).select(
        "id", "customer_email", "support_reply", "category").collect())
    assert len(read_or_generate(spark, path, 50).collect()) == 30       # what is there is read
    assert len(read_or_generate(spark, path, 50, rebuild=True).collect()) == 50
    os.remove(os.path.join(path, "_SUCCESS"))                           # a write that never ended
    assert len(read_or_generate(spark, path, 20).collect()) == 20


def test_limit_shortens_the_holdout(spark, sf):
    t = tickets_from_table(read_table(spark, sf, "documents"), "doc_id")
    r = run(t, RunConfig(limit=4))
    assert r.holdout.count() == r.scores.count() == 4


def test_holdout_rank_first_spreads_categories(spark):
    from replyscope.operators.split import holdout_split
    t = generate_tickets(spark.range(200))
    assert len({r.category for r in holdout_split(t, 2, 5, rank_first=True).collect()}) == 5
    # default order fills the alphabetically first categories: 2 + 2 + 1
    assert len({r.category for r in holdout_split(t, 2, 5).collect()}) == 3
