from fractions import Fraction

import duckdb
import pytest
from pyspark.sql import functions as F

from replyscope.config import RunConfig, Weights
from replyscope.functions.judge import band
from replyscope.functions.score import final_score
from replyscope.operators.summary import describe_overall, summary_table


def test_describe(spark):
    df = spark.createDataFrame([(v, "a") for v in (1.0, 2.0, 10.0, 4.0)], "final_score double, category string")
    r = describe_overall(df).first()
    assert (r["count"], r.mean, r.median, r.min, r.max, r.stdev) == (4, 4.25, 3.0, 1.0, 10.0, 3.49)


def test_describe_empty(spark):
    df = spark.createDataFrame([], "final_score double, category string")
    r = describe_overall(df).first()
    assert (r["count"], r.mean, r.median, r.min, r.max, r.stdev) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    rows = summary_table(df).collect()
    assert len(rows) == 1 and rows[0].category is None and rows[0]["count"] == 0


def test_summary_table_rollup(spark):
    df = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (5.0, "b")], "final_score double, category string")
    rows = {r.category: (r["count"], r.mean) for r in summary_table(df).collect()}
    assert rows == {None: (3, 3.0), "a": (2, 2.0), "b": (1, 5.0)}


def test_final_score(spark):
    df = spark.range(1).select(final_score(F.lit(0.75), F.lit(0.5), F.lit(0.5)).alias("s"))
    assert df.first().s == 62.5


def test_weights_checked_before_any_job():
    with pytest.raises(ValueError):
        Weights(0.5, 0.3, 0.1)
    with pytest.raises(ValueError):
        RunConfig(rubric=())


def test_band_half_even(spark):
    r = spark.range(1).select(band(F.lit(0.375)).alias("a"), band(F.lit(0.625)).alias("b")).first()
    assert (r.a, r.b) == (2, 4)


def half_even(x, d):
    return float(round(Fraction(x) * 10 ** d)) / 10 ** d


@pytest.mark.parametrize("cents", [[15085], [15075], [15080, 15090], [-15085], [-15075, -15075],
                                   [1, 0], [3, 0], [-1, 0], [-3, 0], [5, 5, 5], [1, 1, 3]])
def test_ties_of_means_and_medians_in_both_engines(spark, cents):
    from replyscope.functions.score import rounded_mean
    from replyscope.plans.oracle import mean, middle
    values = [c / 1e5 for c in cents]
    want = half_even(Fraction(sum(cents), 10 ** 5 * len(cents)), 4)
    order = sorted(cents)
    low, high = order[(len(order) - 1) // 2], order[len(order) // 2]
    med = half_even(Fraction(low + high, 2 * 10 ** 5), 2)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert df.agg(rounded_mean(F.col("v"), 4)).first()[0] == want
    assert describe_overall(df, "v").first().median == med
    rows = ", ".join(f"({v!r}::DOUBLE)" for v in values)
    got = duckdb.connect().execute(f"SELECT {mean('v', 4)}, {middle('v', 2)} FROM (VALUES {rows}) t(v)").fetchone()
    assert got == (want, med)


def test_mean_of_twenty_component_scores_on_a_tie(spark):
    from replyscope.operators.summary import component_means
    rows = [(0.1508, 0.0, 0.0, 0.0)] * 10 + [(0.1509, 0.0, 0.0, 0.0)] * 10
    df = spark.createDataFrame(rows, "cosine double, bertscore_f1 double, judge_normalized double, "
                                     "rouge_l_f1 double")
    assert component_means(df).first().cosine == 0.1508
