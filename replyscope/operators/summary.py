"""Describe statistics, component means and run metadata."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Weights
from ..functions.score import round_to, rounded_mean, rounded_middle, scaled

STAT_DECIMALS = 2
MEAN_DECIMALS = 4
COMPONENTS = ("cosine", "bertscore_f1", "judge_normalized", "rouge_l_f1")


def describe_aggs(value: str, approx_median: bool = False) -> list[Column]:
    """A1: count, mean, median (middle pair averaged), min, max, population
    stdev, rounded to 2 places; 0 for an empty input. Mean and median are those
    of the values to six places, exactly, and ties go to the even digit.

    The exact median keeps one counter per distinct value of a group; for the
    final score (two decimals in [0, 100]) that is at most 10,001 counters
    however large the group. ``approx_median`` switches to
    ``percentile_approx`` for unbounded value sets."""
    v = F.col(value).cast("double")
    if approx_median:
        med = round_to(F.percentile_approx(v, 0.5, 10000).cast("double"), STAT_DECIMALS)
    else:
        med = rounded_middle(F.median(scaled(v).cast("bigint")), STAT_DECIMALS)
    zero = F.lit(0.0)
    return [
        F.count(v).cast("bigint").alias("count"),
        F.coalesce(rounded_mean(v, STAT_DECIMALS), zero).alias("mean"),
        F.coalesce(med, zero).alias("median"),
        F.coalesce(round_to(F.min(v), STAT_DECIMALS), zero).alias("min"),
        F.coalesce(round_to(F.max(v), STAT_DECIMALS), zero).alias("max"),
        F.coalesce(round_to(F.stddev_pop(v), STAT_DECIMALS), zero).alias("stdev"),
    ]


def describe_overall(scores: DataFrame, value: str = "final_score",
                     approx_median: bool = False) -> DataFrame:
    """A2: one row, also for an empty input."""
    return scores.agg(*describe_aggs(value, approx_median))


def describe_by_category(scores: DataFrame, value: str = "final_score",
                         category_col: str = "category",
                         approx_median: bool = False) -> DataFrame:
    """A3: one row per category, sorted by category."""
    return (scores.groupBy(category_col).agg(*describe_aggs(value, approx_median))
            .orderBy(category_col))


def summary_table(scores: DataFrame, value: str = "final_score",
                  category_col: str = "category", approx_median: bool = False) -> DataFrame:
    """A2 + A3 in one aggregation (``rollup``): ``is_overall`` marks the
    overall row, whose ``category`` is null; rows without a category are a
    category of their own. A rollup yields nothing on an empty input, so the
    all-zero overall row is added in that case."""
    rolled = (scores.rollup(category_col).agg(*describe_aggs(value, approx_median),
                                              (F.grouping(category_col) == 1).alias("is_overall"))
              .select(F.col(category_col).alias("category"), "is_overall", "count", "mean", "median",
                      "min", "max", "stdev"))
    empty = (scores.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
             .select(F.lit(None).cast("string").alias("category"), F.lit(True).alias("is_overall"),
                     F.lit(0).cast("bigint").alias("count"),
                     *[F.lit(0.0).alias(c) for c in ("mean", "median", "min", "max", "stdev")]))
    return rolled.unionByName(empty)


def component_means(scores: DataFrame, components=COMPONENTS) -> DataFrame:
    """A4: mean of each (already rounded) component, 4 places; 0 if empty."""
    return scores.agg(*[F.coalesce(rounded_mean(F.col(c), MEAN_DECIMALS), F.lit(0.0)).alias(c)
                        for c in components])


def run_meta(scores: DataFrame, weights: Weights = Weights(), embedder: str = "tfidf") -> DataFrame:
    """A5: one row of run metadata. Backends are the set actually used (the
    original system reports the first row's)."""
    return scores.agg(
        F.count(F.lit(1)).cast("bigint").alias("n_evaluated"),
        F.lit(weights.llm_judge).alias("weight_llm_judge"),
        F.lit(weights.bertscore).alias("weight_bertscore"),
        F.lit(weights.cosine).alias("weight_cosine"),
        F.lit(embedder).alias("embedder"),
        F.array_join(F.array_sort(F.collect_set("judge_backend")), ",").alias("judge_backend"),
        F.array_join(F.array_sort(F.collect_set("bertscore_backend")), ",").alias("bertscore_backend"),
    )


def distinct_categories(tickets: DataFrame, category_col: str = "category") -> DataFrame:
    """Number of distinct categories."""
    return tickets.agg(F.count_distinct(category_col).cast("bigint").alias("n_categories"))


def retrieval_hit_rate(cases: DataFrame, queries: DataFrame) -> DataFrame:
    """How often retrieval finds a case of the query's own category, per
    query category: ``category, n_queries, n_cases, top1_hit_rate,
    case_hit_rate``. ``cases(query_id, rank, category)`` has at most k rows
    per query; ``queries(query_id, category)``. Generated tickets hold
    several siblings of every template, so high rates here flatter the
    retriever: report it next to the scores."""
    c = cases.select("query_id", "rank", F.col("category").alias("case_category"))
    j = queries.select("query_id", "category").join(c, "query_id", "left")
    hit = F.when(F.col("case_category") == F.col("category"), F.lit(1.0)).otherwise(F.lit(0.0))
    return (j.groupBy("category")
            .agg(F.count_distinct("query_id").cast("bigint").alias("n_queries"),
                 F.count("case_category").cast("bigint").alias("n_cases"),
                 (F.sum(F.when(F.col("rank") == 1, hit).otherwise(F.lit(0.0)))
                  / F.count_distinct("query_id")).alias("top1_hit_rate"),
                 F.coalesce(F.avg(F.when(F.col("case_category").isNotNull(), hit)),
                            F.lit(0.0)).alias("case_hit_rate")))
