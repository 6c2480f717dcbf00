"""Ticket CSV source/sink and the four report outputs.

Every output is written by Spark writers from DataFrames; only the summary,
whose size is O(categories), is coalesced into one file."""
from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_RUBRIC, DEFAULT_SEED
from ..session import complete, delete_tree, versions
from .tickets import generate_tickets

TICKET_SCHEMA = "id BIGINT, customer_email STRING, support_reply STRING, category STRING"

# Summary text layout.
RULE_WIDTH = 66
SUMMARY_TITLE = " REPLY EVAL — SUMMARY"
CATEGORY_WIDTH = 20


# Texts are written as they are: outer white space stays, a null and an empty
# text are told apart (a text that is just \\N reads as null).
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false", "nullValue": "\\N"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_tickets_csv(spark: SparkSession, path: str) -> DataFrame:
    """Tickets from CSV with an explicit schema (no inference);
    multi-line quoted fields allowed."""
    return (spark.read.schema(TICKET_SCHEMA).options(**CSV_OPTIONS)
            .option("multiLine", True).csv(path))


def write_tickets_csv(tickets: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tickets to CSV with a header."""
    write_csv(tickets.select("id", "customer_email", "support_reply", "category"), path, mode)


def read_or_generate(spark: SparkSession, path: str, n: int, seed: int = DEFAULT_SEED,
                     rebuild: bool = False) -> DataFrame:
    """The tickets of a CSV at ``path``, or ``n`` generated ones (D1, ids from
    0), written there first, where none is (or its write hasn't ended) or a
    ``rebuild`` is wanted."""
    if rebuild or not complete(spark, path):
        write_tickets_csv(generate_tickets(spark.range(n), seed=seed), path)
    return read_tickets_csv(spark, path)


def generated_rows(generations: DataFrame, holdout: DataFrame) -> DataFrame:
    """S3 rows: ``id, category, customer_email, generated_reply,
    reference_reply, provider, retrieved_ids`` (ids joined by ``|`` in rank
    order); a missing reference or category becomes ``''``."""
    refs = holdout.select(F.col("id").alias("query_id"), "category",
                          F.col("support_reply").alias("reference_reply"))
    ids = F.array_join(F.transform(F.array_sort("retrieved"),
                                   lambda r: r["id"].cast("string")), "|")
    return (generations.join(refs, "query_id", "left")
            .select(F.col("query_id").alias("id"), F.coalesce("category", F.lit("")).alias("category"),
                    F.col("query_email").alias("customer_email"),
                    F.col("reply").alias("generated_reply"),
                    F.coalesce("reference_reply", F.lit("")).alias("reference_reply"),
                    "provider", ids.alias("retrieved_ids")))


def scores_wide(scores: DataFrame, rubric=DEFAULT_RUBRIC) -> DataFrame:
    """S4 rows: the score row without rationale and map, plus one
    ``judge_<dim>`` column per rubric dimension."""
    base = [c for c in scores.columns
            if c not in ("judge_dimensions", "judge_rationale") and c not in rubric]
    return scores.select(*base, *[F.col("judge_dimensions")[d].cast("int").alias(f"judge_{d}")
                                  for d in rubric])


def per_email(scores: DataFrame, rubric=DEFAULT_RUBRIC) -> DataFrame:
    """S5 rows: the score row with its map of dimensions, without a column
    per dimension."""
    return scores.select(*[c for c in scores.columns if c not in rubric])


def _fmt(c) -> F.Column:
    """Python-style text of a rounded double: trailing zeros dropped, at
    least one decimal (``77.5``, ``80.0``)."""
    s = F.regexp_replace(F.format_string("%.6f", c), "0+$", "")
    return F.regexp_replace(s, r"\.$", ".0")


def _pad(c, width: int, left: bool) -> F.Column:
    """Pad like Python's format spec: never truncate."""
    padded = F.lpad(c, width, " ") if left else F.rpad(c, width, " ")
    return F.when(F.length(c) >= width, c).otherwise(padded)


def _block(df: DataFrame, first_line: int, lines: list) -> DataFrame:
    """Lines computed from a one-row table, numbered from ``first_line``."""
    return df.select(F.posexplode(F.array(*lines)).alias("pos", "line")).select(
        (F.col("pos") + first_line).cast("bigint").alias("line_no"), "line")


def summary_lines(summary: DataFrame, components: DataFrame, meta: DataFrame) -> DataFrame:
    """S6 as rows ``line_no, line``: the fixed-width digest. Inputs are one
    row per category and two single-row tables; each block of lines comes
    from its own table and the blocks are concatenated with ``unionByName``."""
    rule_eq, rule_dash = "=" * RULE_WIDTH, "-" * RULE_WIDTH
    head = [F.lit(rule_eq), F.lit(SUMMARY_TITLE), F.lit(rule_eq),
            F.concat(F.lit(" Emails evaluated : "), F.col("n_evaluated").cast("string")),
            F.concat(F.lit(" Embedder         : "), F.col("embedder")),
            F.concat(F.lit(" Judge backend    : "), F.col("judge_backend")),
            F.concat(F.lit(" BERTScore backend: "), F.col("bertscore_backend")),
            F.concat(F.lit(" Weights          : {'llm_judge': "), _fmt(F.col("weight_llm_judge")),
                     F.lit(", 'bertscore': "), _fmt(F.col("weight_bertscore")),
                     F.lit(", 'cosine': "), _fmt(F.col("weight_cosine")), F.lit("}")),
            F.lit(rule_dash), F.lit(" OVERALL FINAL SCORE (0-100)")]
    overall = [F.concat(F.lit("   mean="), _fmt(F.col("mean")), F.lit("  median="),
                        _fmt(F.col("median")), F.lit("  min="), _fmt(F.col("min")),
                        F.lit("  max="), _fmt(F.col("max")), F.lit("  stdev="),
                        _fmt(F.col("stdev"))),
               F.lit(rule_dash), F.lit(" COMPONENT MEANS (0-1)")]
    comps = [F.concat(F.lit("   LLM judge (norm) : "), _fmt(F.col("judge_normalized"))),
             F.concat(F.lit("   BERTScore F1     : "), _fmt(F.col("bertscore_f1"))),
             F.concat(F.lit("   Cosine           : "), _fmt(F.col("cosine"))),
             F.concat(F.lit("   ROUGE-L F1 (diag): "), _fmt(F.col("rouge_l_f1"))),
             F.lit(rule_dash), F.lit(" PER-CATEGORY FINAL SCORE (mean / count)")]
    n1, n2, n3 = len(head), len(head) + len(overall), len(head) + len(overall) + len(comps)
    cats = summary.where(~F.col("is_overall")).select(
        "category", F.concat(F.lit("   "), _pad(F.coalesce("category", F.lit("")),
                                                CATEGORY_WIDTH, False),
                             F.lit(" "), _pad(_fmt(F.col("mean")), 6, True),
                             F.lit("   (n="), F.col("count").cast("string"), F.lit(")")).alias("line"))
    # One row per category, which a person reads: few rows in one task.
    body = cats.select((F.row_number().over(Window.orderBy("category")) + F.lit(n3 - 1))
                       .cast("bigint").alias("line_no"), "line")
    n_cats = summary.where(~F.col("is_overall")).agg(F.count(F.lit(1)).alias("n"))
    last = n_cats.select((F.col("n") + n3).cast("bigint").alias("line_no"),
                         F.lit(rule_eq).alias("line"))
    return (_block(meta, 0, head)
            .unionByName(_block(summary.where("is_overall"), n1, overall))
            .unionByName(_block(components, n2, comps))
            .unionByName(body).unionByName(last))


# Reports whose files are kept: the one that is shown and, for readers that have
# begun, the one before it.
KEPT_REPORTS = 2
OUTPUTS = ("generated", "scores", "per_email", "summary", "component_means", "meta", "summary_txt")


def write_report(result, out_dir: str, rubric=DEFAULT_RUBRIC, keep: int = KEPT_REPORTS) -> str:
    """Write ``generated`` and ``scores`` (CSV), ``per_email`` (JSON lines),
    ``summary``, ``component_means``, ``meta`` (JSON) and ``summary_txt`` for one
    run, all or nothing: the outputs go to a folder of the run, and only when
    they are all there a numbered entry names it, which ``report_path`` reads.
    A run that ends in between leaves the report before it as it was, and can be
    started again. The scores of a ``RunResult`` are a table already, so the
    outputs that read them scan it; the small ones are gathered by a shuffle of
    their few rows. Gives the run's folder."""
    spark = result.scores.sparkSession
    folder = os.path.join(out_dir, "runs", uuid.uuid4().hex)
    mode = "errorifexists"
    write_csv(generated_rows(result.generations, result.holdout),
              os.path.join(folder, "generated"), mode)
    write_csv(scores_wide(result.scores, rubric), os.path.join(folder, "scores"), mode)
    per_email(result.scores, rubric).write.mode(mode).json(os.path.join(folder, "per_email"))

    def json(df: DataFrame, name: str) -> None:
        df.repartition(1).write.mode(mode).json(os.path.join(folder, name))

    json(result.summary, "summary")
    json(result.components, "component_means")
    json(result.meta, "meta")
    (summary_lines(result.summary, result.components, result.meta).repartition(1)
     .sortWithinPartitions("line_no").select("line")
     .write.mode(mode).text(os.path.join(folder, "summary_txt")))
    entries = os.path.join(out_dir, "reports")
    shown = versions(spark, entries)
    spark.createDataFrame([(folder,)], "value string").coalesce(1).write.mode("overwrite").text(
        os.path.join(entries, str(max(shown, default=0) + 1)))
    for old in shown[:max(0, len(shown) + 1 - keep)]:
        delete_tree(spark, _run_folder(spark, out_dir, old))
        delete_tree(spark, os.path.join(entries, str(old)))
    return folder


def _run_folder(spark: SparkSession, out_dir: str, entry: int) -> str:
    return spark.read.text(os.path.join(out_dir, "reports", str(entry))).first()[0]


def report_path(spark: SparkSession, out_dir: str, output: str) -> str:
    """The folder of an output (one of ``OUTPUTS``) of the last whole report
    under ``out_dir``."""
    if output not in OUTPUTS:
        raise ValueError(f"no such output: {output!r}")
    shown = versions(spark, os.path.join(out_dir, "reports"))
    if not shown:
        raise FileNotFoundError(f"no whole report under {out_dir}")
    return os.path.join(_run_folder(spark, out_dir, shown[-1]), output)
