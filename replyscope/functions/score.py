"""The weighted final score and the rounded score row."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Weights


def round_to(value: Column, decimals: int) -> Column:
    """Round half-even on ``value * 10^d`` (IEEE double arithmetic, so any
    engine gets the same bits; close to Python's ``round`` on floats)."""
    scale = float(10 ** decimals)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


# Places kept of the numbers whose mean or median is taken.
EXACT_DECIMALS = 6


def scaled(value: Column) -> Column:
    """A number with at most ``EXACT_DECIMALS`` places as a whole number of its
    last place."""
    return F.rint(value * F.lit(float(10 ** EXACT_DECIMALS))).cast("decimal(20,0)")


def rounded_mean(value: Column, decimals: int) -> Column:
    """Aggregate: the mean, rounded half-even to ``decimals`` places. Sum,
    quotient and remainder are whole numbers, so a tie is seen as one whatever
    the order of the rows; null for no values."""
    total = F.sum(scaled(value)).cast("decimal(38,0)")
    parts = F.count(value).cast("decimal(20,0)") * F.lit(10 ** (EXACT_DECIMALS - decimals))
    rest = F.pmod(total, parts)
    floor = ((total - rest) / parts).cast("decimal(38,0)")
    up = (rest * 2 > parts) | ((rest * 2 == parts) & (F.pmod(floor, F.lit(2)) != 0))
    return F.when(F.count(value) > 0,
                  (floor + F.when(up, 1).otherwise(0)).cast("double") / F.lit(float(10 ** decimals)))


def rounded_middle(middle: Column, decimals: int) -> Column:
    """A median of ``scaled`` numbers, which is whole or half, rounded half-even:
    the quotient of two such numbers is exact where it is a tie."""
    return (F.rint(middle / F.lit(float(10 ** (EXACT_DECIMALS - decimals))))
            / F.lit(float(10 ** decimals)))


def final_score(judge_norm: Column, bert_f1: Column, cosine: Column,
                weights: Weights = Weights()) -> Column:
    """``round(100 * (wj*judge + wb*f1 + wc*cosine), 2)`` from unrounded
    inputs. ``Weights`` already checked the sum on the driver."""
    raw = (F.lit(weights.llm_judge) * judge_norm + F.lit(weights.bertscore) * bert_f1
           + F.lit(weights.cosine) * cosine)
    return round_to(F.lit(100.0) * raw, 2)


# Decimals of each score-row column.
ROUNDING = {
    "cosine": 4, "bertscore_precision": 4, "bertscore_recall": 4, "bertscore_f1": 4,
    "judge_avg_1to5": 3, "judge_normalized": 4, "rouge_l_f1": 4,
}


def rounded(name: str, value: Column) -> Column:
    return round_to(value, ROUNDING[name]).alias(name)
